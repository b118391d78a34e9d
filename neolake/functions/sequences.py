"""Peptide and nucleotide expressions."""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The standard genetic code, in TCAG order; Kyte-Doolittle hydropathy; residue masses (average, Da).
_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
HYDROPATHY = {"A": 1.8, "R": -4.5, "N": -3.5, "D": -3.5, "C": 2.5, "Q": -3.5, "E": -3.5, "G": -0.4, "H": -3.2, "I": 4.5, "L": 3.8, "K": -3.9, "M": 1.9, "F": 2.8, "P": -1.6, "S": -0.8, "T": -0.7, "W": -0.9, "Y": -1.3, "V": 4.2}
MASS = {"A": 71.0788, "R": 156.1875, "N": 114.1038, "D": 115.0886, "C": 103.1388, "E": 129.1155, "Q": 128.1307, "G": 57.0519, "H": 137.1411, "I": 113.1594, "L": 113.1594, "K": 128.1741, "M": 131.1926, "F": 147.1766, "P": 97.1167, "S": 87.0782, "T": 101.1051, "W": 186.2132, "Y": 163.1760, "V": 99.1326}
WATER = 18.01528

CODONS = {"".join(c): a for c, a in zip(itertools.product("TCAG", repeat=3), _CODE)}
#: Two bases whose codons all mean one amino acid.
_SHORT = {x + y: CODONS[x + y + "T"] for x, y in itertools.product("TCAG", repeat=2) if len({CODONS[x + y + z] for z in "TCAG"}) == 1}


def _map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def places(n: Column, last: Column | int = 0) -> Column:
    """1 .. n - last, empty if there is none (a falling sequence never comes out)."""
    end = n - last
    return F.when(end >= 1, F.sequence(F.lit(1), F.greatest(end, F.lit(1)).cast("int"))).otherwise(F.array().cast("array<int>"))


#: Letters up to which a text is cut at every place from its start; longer ones are cut into pieces first, as each such cut walks the text.
SHORT = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also inside the lambdas of ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def kmers(sequence: Column, k: int | Column) -> Column:
    """Structs (position from 1, kmer), in time that grows with the length of the text."""
    k = F.lit(k) if isinstance(k, int) else k
    cut = lambda s, before: F.transform(places(F.length(s), k - 1), lambda i: F.struct((i + before).cast("int").alias("position"), s.substr(i, k).alias("kmer")))
    size = F.greatest(F.lit(SHORT), k)  # so that a k-mer ends in its piece or the next one
    pieces = F.regexp_extract_all(sequence, F.concat(F.lit("(?s).{1,"), size.cast("string"), F.lit("}")), F.lit(0))
    whole = lambda p: F.transform(p, lambda x, i: F.struct(F.concat(x, F.coalesce(F.left(F.try_element_at(p, i + 2), k - 1), F.lit(""))).alias("piece"), (i * size).alias("before")))
    # the k-1 letters of the next piece add no k-mer of their own
    long = let(pieces, lambda p: F.flatten(F.transform(whole(p), lambda x: cut(x["piece"], x["before"]))))
    return F.when(F.length(sequence) <= SHORT, cut(sequence, F.lit(0))).otherwise(long)


def every_kmer(sequence: Column, lengths: list[int]) -> Column:
    """Structs (length, position from 1, epitope) of all lengths."""

    def of(k: int) -> Column:
        return F.transform(kmers(sequence, k), lambda x: F.struct(F.lit(k).alias("length"), x["position"].alias("position"), x["kmer"].alias("epitope")))

    return F.flatten(F.array(*map(of, lengths)))


def letters(sequence: Column) -> Column:
    short = F.transform(places(F.length(sequence)), lambda i: sequence.substr(i, F.lit(1)))
    return F.when(F.length(sequence) <= SHORT, short).otherwise(F.regexp_extract_all(sequence, F.lit("(?s)."), F.lit(0)))


def _same(a: Column, b: Column) -> Column:
    """For each place of the longer text whether both have the same letter there."""
    return F.zip_with(letters(a), letters(b), lambda x, y: F.coalesce(x == y, F.lit(False)))


def mutated_positions(mutant: Column, wildtype: Column) -> Column:
    """Positions where the two differ, joined by ``, ``; null without a wild type."""
    at = F.filter(F.transform(F.slice(_same(mutant, wildtype), F.lit(1), F.length(mutant)), lambda same, i: F.when(~same, i + 1)), lambda i: i.isNotNull())
    return F.when(wildtype.isNotNull(), F.array_join(at.cast("array<string>"), ", "))


def matches(a: Column, b: Column) -> Column:
    """Number of positions with equal residues."""
    return F.size(F.filter(_same(a, b), lambda same: same))


def matches_from_left(a: Column, b: Column) -> Column:
    """Length of the common prefix."""
    first = F.array_position(_same(a, b), F.lit(False)).cast("int")
    return let(first, lambda i: F.when(i > 0, i - 1).otherwise(F.least(F.length(a), F.length(b))))


def matches_from_right(a: Column, b: Column) -> Column:
    return matches_from_left(F.reverse(a), F.reverse(b))


def changed_window(mutant: Column, wildtype: Column, flank: int, to_end: bool = False, shown: Column | None = None) -> Column:
    """The part of ``mutant`` that differs from ``wildtype`` with ``flank`` residues on either side (``to_end``: all that follows), or what ``shown`` has there."""
    ends = F.struct(matches_from_left(mutant, wildtype).alias("left"), matches_from_right(mutant, wildtype).alias("right"))
    text = mutant if shown is None else shown

    def cut(same: Column) -> Column:
        right = F.least(same["right"], F.least(F.length(mutant), F.length(wildtype)) - same["left"])
        start = F.greatest(same["left"] - flank + 1, F.lit(1))
        stop = F.length(mutant) if to_end else F.least(F.length(mutant) - right + flank, F.length(mutant))
        return text.substr(start.cast("int"), F.greatest(stop - start + 1, F.lit(0)).cast("int"))

    return let(ends, cut)


def centred(sequence: Column, position: Column, flank: int) -> Column:
    """Up to 2 * flank + 1 residues around a 1-based position, moved inwards at either end."""
    n, size = F.length(sequence), F.least(F.lit(2 * flank + 1), F.length(sequence))
    start = F.greatest(F.lit(1), F.least(position - flank, n - size + 1))
    return sequence.substr(start.cast("int"), size.cast("int"))


def frameshift_window(sequence: Column, position: Column, flank: int, downstream: int | None = None) -> Column:
    """From ``flank`` residues before a position to the end, or to ``downstream`` residues after it."""
    start = F.greatest(F.lit(1), position - flank)
    stop = F.length(sequence) if downstream is None else F.least(F.length(sequence), position + downstream)
    return sequence.substr(start.cast("int"), F.greatest(stop - start + 1, F.lit(0)).cast("int"))


def mutated_protein(protein: Column, change: Column, position: Column, given: Column | None = None) -> Column:
    """A protein with the change ``wild/mutant`` at a 1-based position; ``-`` is nothing, a stop ends it, an unfitting change gives null.

    ``given``: the protein that the change has to fit, if ``protein`` is that one with other changes.
    """
    wild = F.replace(F.split_part(change, F.lit("/"), F.lit(1)), F.lit("-"), F.lit(""))
    mutant = F.replace(F.split_part(change, F.lit("/"), F.lit(2)), F.lit("-"), F.lit(""))
    fits = (protein if given is None else given).substr(position.cast("int"), F.length(wild)) == wild
    # an insertion comes after the residue at its position
    before = F.when(wild == "", position).otherwise(position - 1)
    out = F.concat(F.substr(protein, F.lit(1), before.cast("int")), mutant, F.substr(protein, (before + F.length(wild) + 1).cast("int")))
    return F.when(fits, F.regexp_extract(out, r"^[^*X]*", 0))


def overlaid(sequence: Column, changes: Column) -> Column:
    """Changes (pos, wild, mutant) of equal lengths laid over a sequence in their order, where the wild residues fit."""
    return F.aggregate(changes, sequence, lambda s, c: F.when(s.substr(c["pos"], F.length(c["wild"])) == c["wild"], F.overlay(s, c["mutant"], c["pos"], F.length(c["wild"]))).otherwise(s))


def translate_dna(dna: Column, whole: bool = False, padded: bool = False) -> Column:
    """Amino acids up to the first stop (``whole``: stops as ``*``); an unknown codon is X; a rest of one or two bases is dropped.

    ``padded``: the rest counts as a codon whose missing bases may be any: the amino
    acid that all such codons have, or X.
    """
    table = _map(CODONS if not padded else CODONS | _SHORT)
    codons = F.regexp_extract_all(dna, F.lit("(?s).{1,3}" if padded else "(?s).{3}"), F.lit(0))
    aa = F.array_join(F.transform(codons, lambda c: F.coalesce(F.try_element_at(table, F.upper(c)), F.lit("X"))), "")
    return aa if whole else F.regexp_extract(aa, r"^[^*]*", 0)


def reverse_complement(dna: Column) -> Column:
    return F.translate(F.reverse(dna), "ACGTacgt", "TGCAtgca")


def merged_codon(changes: Column) -> Column:
    """One codon from several ``aCg/aTg`` changes of it: the upper-case bases of each in turn."""
    wild = F.upper(F.split_part(changes[0], F.lit("/"), F.lit(1)))

    def put(codon: Column, change: Column) -> Column:
        mutant = F.split_part(change, F.lit("/"), F.lit(2))
        base = lambda i: F.when(mutant.substr(i, F.lit(1)).rlike("[A-Z]"), mutant.substr(i, F.lit(1))).otherwise(codon.substr(i, F.lit(1)))
        return F.array_join(F.transform(F.sequence(F.lit(1), F.lit(3)), base), "")

    return F.aggregate(changes, wild, put)


# One common human codon for each amino acid.
PREFERRED_CODONS = {"A": "GCC", "C": "TGC", "D": "GAC", "E": "GAG", "F": "TTC", "G": "GGC", "H": "CAC", "I": "ATC", "K": "AAG", "L": "CTG", "M": "ATG", "N": "AAC", "P": "CCC", "Q": "CAG", "R": "AGA", "S": "AGC", "T": "ACC", "V": "GTG", "W": "TGG", "Y": "TAC"}


def back_translated(protein: Column) -> Column:
    table = _map(PREFERRED_CODONS)
    return F.array_join(F.transform(letters(protein), lambda a: F.coalesce(F.try_element_at(table, a), F.lit("NNN"))), "")


def molecular_weight(protein: Column) -> Column:
    table = _map(MASS)
    return F.round(F.aggregate(letters(protein), F.lit(WATER), lambda t, a: t + F.coalesce(F.try_element_at(table, a), F.lit(0.0))), 4)


def _gravy(part: Column) -> Column:
    table = _map(HYDROPATHY)
    total = F.aggregate(letters(part), F.lit(0.0).cast("double"), lambda t, a: t + F.coalesce(F.try_element_at(table, a), F.lit(0.0)))
    return total / F.length(part)


def manufacturability(sequence: Column) -> dict[str, Column]:
    """Eight measures of how hard a peptide is to make; null below seven residues."""
    n = F.length(sequence)
    sevens = F.transform(kmers(sequence, 7), lambda x: _gravy(x["kmer"]))
    count = lambda pattern: F.regexp_count(sequence, F.lit(pattern))
    last, first = sequence.substr(n, F.lit(1)), sequence.substr(F.lit(1), F.lit(1))
    measures = {
        "cterm_7mer_gravy_score": F.round(_gravy(sequence.substr(n - 6, F.lit(7))), 6), "max_7mer_gravy_score": F.round(F.array_max(sevens), 6), "difficult_n_terminal_residue": first.isin("Q", "E", "C"), "c_terminal_cysteine": last == "C",
        "c_terminal_proline": last == "P", "cysteine_count": count("C"), "n_terminal_asparagine": first == "N", "asparagine_proline_bond_count": count("NP"),
    }
    return {k: F.when(n >= 7, v) for k, v in measures.items()}


def core_position(start: Column, core: Column, peptide: Column) -> Column:
    """Where a peptide starts if the predictor names the start of its core."""
    return F.when(F.contains(peptide, core), start - F.position(core, peptide) + 1).otherwise(start)


def window_around(sequence: Column, epitope: Column, flank: int, near: Column) -> Column:
    """The epitope's occurrence closest to a position, with ``flank`` residues on either side."""
    n = F.length(epitope)
    starts = F.filter(kmers(sequence, n), lambda x: x["kmer"] == epitope)
    best = F.array_min(F.transform(starts, lambda x: F.struct(F.abs(x["position"] - near).alias("d"), x["position"].alias("i"))))["i"]
    start = F.greatest(best - flank, F.lit(1))
    return sequence.substr(start, F.least(best + n - 1 + flank, F.length(sequence)) - start + 1)


def residue_styles(sequence: Column, mutated: Column, bound_one: Column, bound_two: Column, difficult: Column) -> Column:
    """(aa, bold, color, underline, large) of every residue, from arrays of positions."""
    has = lambda a, i: F.coalesce(F.array_contains(a, i), F.lit(False))
    return F.transform(
        letters(sequence),
        lambda x, i: F.struct(x.alias("aa"), has(bound_two, i + 1).alias("bold"), has(bound_one, i + 1).alias("color"), has(mutated, i + 1).alias("underline"), has(difficult, i + 1).alias("large")),
    )


# --- ids ---------------------------------------------------------------------------


def short_peptide_id(peptide_id: Column) -> Column:
    """``gene.transcript.change`` of ``gene.transcript.kind.change``; frameshifts as ``FS`` and position, deletions as residues, place, residues.

    An id of another form is an error; one of another kind stays as it is.
    """
    pattern = r"^([\w\-]+)\.(ENS[0-9A-Z]+\d+(?:\.\d+)?)\.(\w+)\.(.+)$"
    gene, transcript, kind, change = (F.regexp_extract(peptide_id, pattern, k) for k in range(1, 5))
    deletion = r"^(\d+-\d+)([A-Z*/]+)/([A-Z*/]+)"
    place, lost, new = (F.regexp_extract(change, deletion, k) for k in range(1, 4))
    dotted = lambda last: F.concat_ws(".", gene, transcript, last)
    out = F.when(~peptide_id.rlike(pattern), F.raise_error(F.concat(F.lit("no peptide id: "), peptide_id)))
    out = out.when(kind.isin("missense", "inframe_ins"), dotted(change)).when(kind == "FS", dotted(F.concat(F.lit("FS"), F.regexp_replace(change, r"[^\d-]", ""))))
    return out.when((kind == "inframe_del") & change.rlike(deletion), dotted(F.concat(lost, place, new))).when(kind == "inframe_del", F.replace(peptide_id, F.lit("inframe_del."), F.lit(""))).otherwise(peptide_id)


def rearranged_change(change: Column) -> Column:
    """``518G/D`` from ``G518D``; anything else stays."""
    pattern = r"^([A-Za-z]+)([\d-]+)([A-Za-z]*).*$"
    return F.when(change.rlike(pattern), F.regexp_replace(change, pattern, "$2$1/$3")).otherwise(change)


def id_parts(peptide_id: Column) -> Column:
    """The parts of an id that dashes join; an allele's ``HLA`` stays with what follows it."""
    return F.transform(F.split(F.regexp_replace(peptide_id, r"(^|-)HLA-(?=[^-])", "$1HLA\u0001"), "-"), lambda x: F.replace(x, F.lit("\u0001"), F.lit("-")))


def score_of_method(method: Column, fields: Column) -> Column:
    """The score in a predictor's output row (a map from field to text): elution and immunogenicity methods have fields of their own, the others an IC50."""
    name = F.lower(method)
    of = lambda c: F.try_element_at(fields, F.lit(c)).try_cast("double")
    named = {"deepimmuno": "immunogenicity", "bigmhc_el": "BigMHC_EL", "bigmhc_im": "BigMHC_IM", "netmhcpan_el": "score"}
    out = F.when(F.contains(name, F.lit("netmhciipan_el")), F.coalesce(of("score"), of("ic50")))
    for k, v in named.items():
        out = out.when(name == k, of(v))
    return out.otherwise(of("ic50"))
