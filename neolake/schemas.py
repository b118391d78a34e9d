"""Column sets, sentinels and parameters of the epitope tables.

Internally missing values are null; the text forms of the sentinels are kept
where they carry meaning (``Not Run``, ``Not Supported``, ``None``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

NA, NOT_RUN, NOT_SUPPORTED, NONE = "NA", "Not Run", "Not Supported", "None"


def _struct(spec: str) -> T.StructType:
    kinds = {"s": T.StringType(), "i": T.IntegerType(), "d": T.DoubleType(), "b": T.BooleanType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (x.split(":") for x in spec.split())])


VARIANTS = _struct(
    "chromosome_name:s start:i stop:i reference:s variant:s gene_name:s transcript_name:s transcript_support_level:s canonical:s mane_select:s "
    "transcript_length:i biotype:s transcript_cds_flags:s amino_acid_change:s codon_change:s ensembl_gene_id:s hgvsc:s hgvsp:s "
    "wildtype_amino_acid_sequence:s frameshift_amino_acid_sequence:s variant_type:s protein_position:s transcript_expression:d gene_expression:d "
    "normal_depth:i normal_vaf:d tdna_depth:i tdna_vaf:d trna_depth:i trna_vaf:d index:s protein_length_change:s"
)
PREDICTIONS = _struct("index:s allele:s length:i position:i peptide_type:s epitope:s method:s score_type:s score:d percentile_type:s percentile:d")
JUNCTIONS = _struct(
    "chrom:s start:i end:i name:s score:i strand:s splice_site:s acceptors_skipped:i exons_skipped:i donors_skipped:i anchor:s known_donor:i "
    "known_acceptor:i known_junction:i gene_names:s gene_ids:s transcripts:s variant_info:s"
)
METHOD_SUPPORT = _struct("method:s allele:s length:i")


@dataclass(frozen=True)
class Thresholds:
    """Cut-offs of filters and tiers, with the reference's defaults."""

    binding: float = 500.0
    percentile: float | None = None
    fold_change: float | None = None
    strategy: str = "conservative"
    inclusion: float = 5000.0
    top_peptides: int = 15
    normal_depth: int = 5
    normal_vaf: float = 0.02
    tdna_depth: int = 10
    tdna_vaf: float = 0.25
    trna_depth: int = 10
    trna_vaf: float = 0.25
    expression: float = 1.0
    read_support: int = 5
    fusion_expression: float = 0.1
    tsl: int = 1
    transcript_strategies: tuple[str, ...] = field(default=("canonical", "mane_select", "tsl"))
    exclude_nas: bool = False

    @property
    def allele_expression(self) -> float:
        return self.trna_vaf * self.expression * 10
