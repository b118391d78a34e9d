"""The viewer's metrics: for each variant its transcript sets, their peptides, and every algorithm's calls, as one object."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from neolake.functions.filters import col
from neolake.operators.aggregate import set_line, sets_of
from neolake.operators.candidates import number
from neolake.schemas import NONE
from neolake.storage import spread

#: Fixed value: elution and immunogenicity methods that give no percentile.
UNRANKED = ("MHCflurryEL Processing", "BigMHC_EL", "BigMHC_IM", "DeepImmuno")


def _quoted(value: Column) -> Column:
    """A number, or "NA" for one that isn't there, as a value of either kind."""
    return F.parse_json(F.coalesce(value.cast("string"), F.lit('"NA"')))


def _double(value: Column) -> Column:
    """``_quoted`` of a double, with the same text; only very small and very large ones are read from texts."""
    size = F.abs(value)
    whole = (size < 1e7) & (value == F.floor(value))
    out = F.when(value.isNull(), F.parse_json(F.lit('"NA"'))).when(whole, value.cast("long").cast("variant"))
    return out.when((size < 1e7) & (size >= 1e-3), value.cast("decimal(28,20)").cast("variant")).otherwise(F.parse_json(value.cast("string")))


def _name(text: Column) -> Column:
    """A text in quotes."""
    listed = F.to_json(F.array(text))
    return listed.substr(F.lit(2), F.length(listed) - 2)


def _object(entries: Column, key: str, text: str) -> Column:
    """The JSON of an object from an array of structs with names and JSON texts, in their order."""
    return F.concat(F.lit("{"), F.array_join(F.transform(entries, lambda x: F.concat(_name(x[key]), F.lit(":"), x[text])), ","), F.lit("}"))


def _led_by(name: str, text: Column, rest: Column) -> Column:
    """The JSON of a struct with one more field before the others."""
    others = F.to_json(rest, {"ignoreNullFields": "false"})
    return F.concat(F.lit(f'{{"{name}":'), text, F.lit(","), others.substr(F.lit(2), F.length(others)))


def _calls(algorithms: list[str], elution: list[str]) -> dict[str, tuple[list[str], str]]:
    """Names of the lists of calls, with their methods and the measure that they hold."""
    ranked = [a for a in [*algorithms, *elution] if a not in UNRANKED]
    return {"individual_ic50_calls": (algorithms, "IC50 Score"), "individual_ic50_percentile_calls": (algorithms, "Percentile"), "individual_el_calls": (elution, "Score"), "individual_el_percentile_calls": (elution, "Percentile"), "individual_percentile_calls": (ranked, "Percentile")}


def _peptides(df: DataFrame, keys: list[str], transcript: str, calls: dict[str, tuple[list[str], str]], prefix: str, anchor: str | None, kept: Column | None = None) -> DataFrame:
    """One row a transcript and peptide of rows with ``_at``, their order: the last row of each allele, alleles that fail, what all rows share, the first row's ``kept`` as ``_line``."""
    has = lambda c: c in df.columns
    wild = {"Best": "Corresponding"}.get(prefix, prefix)
    value = lambda c: number(c) if has(c) else F.lit(None).cast("double")
    listed = lambda side, names, measure: F.array(*[F.lit(None).cast("double") if measure == "Percentile" and m in UNRANKED else value(f"{m} {side} {measure}") for m in names]).cast("array<double>")
    line = F.struct(
        *[value(f"{p} {side} IC50 Score").alias(f"ic50_{side}") for side, p in (("MT", prefix), ("WT", wild))], *[value(f"{p} {side} Percentile").alias(f"rank_{side}") for side, p in (("MT", prefix), ("WT", wild))],
        *[listed(side, names, measure).alias(f"{name}_{side}") for name, (names, measure) in calls.items() for side in ("MT", "WT")],
    )
    by = [*[col(k) for k in keys], col(transcript).alias("_transcript"), col("MT Epitope Seq").alias("_peptide")]
    fails = ~F.coalesce(col(anchor), F.lit(False)) if anchor else F.lit(False)
    shared = F.struct(col("Mutation Position").cast("string").alias("place") if has("Mutation Position") else F.lit(None).cast("string").alias("place"), (F.coalesce(col("Problematic Positions").cast("string"), F.lit(NONE)) if has("Problematic Positions") else F.lit(NONE)).alias("problem"), col("WT Epitope Seq").alias("wt"), (col("Variant Type") if has("Variant Type") else F.lit(None).cast("string")).alias("kind"), (F.lit(None) if kept is None else kept).alias("line"))
    each = df.groupBy(*by, col("HLA Allele").alias("_allele")).agg(F.max_by(line, F.col("_at")).alias("_values"), F.min_by(shared, F.col("_at")).alias("_shared"), F.min("_at").alias("_at"), F.min(F.when(fails, F.col("_at"))).alias("_fail"))
    entry = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("_allele").alias("k"), F.col("_values").alias("v")))))
    fail = F.transform(F.array_sort(F.collect_list(F.when(F.col("_fail").isNotNull(), F.struct("_fail", "_allele")))), lambda x: x["_allele"])
    out = each.groupBy(*[col(k) for k in keys], "_transcript", "_peptide").agg(entry.alias("_by"), fail.alias("_fails"), F.min_by("_shared", F.col("_at")).alias("_shared"), F.min("_at").alias("_at"))
    return out.withColumn("_line", F.col("_shared.line"))


def _told(of: Callable[[str], Column], alleles: list[str], calls: dict[str, tuple[list[str], str]]) -> tuple[Column, Column]:
    """The place of a peptide among others, and its detail, from the fields of a row of ``_peptides``."""
    names = F.array(*[F.lit(a) for a in sorted(alleles)])
    in_order = lambda f: F.transform(names, lambda a: F.when(~F.map_contains_key(of("_by"), a), F.parse_json(F.lit('"X"'))).otherwise(_double(F.try_element_at(of("_by"), a)[f])))
    told = lambda f: F.transform_values(of("_by"), lambda _, v: F.transform(v[f], _double))
    shared = of("_shared")
    missing = F.when(shared["kind"] == "FS", "FS-NA").when(shared["kind"] == "inframe_ins", "INS-NA").when(shared["kind"] == "inframe_del", "DEL-NA").otherwise("NA")
    detail = F.struct(
        *[in_order(f"{short}_{side}").alias(f"{name}_{side}") for side in ("MT", "WT") for name, short in (("ic50s", "ic50"), ("percentiles", "rank"))], names.alias("hla_types"), F.coalesce(shared["place"], F.lit("NA")).alias("mutation_position"), shared["problem"].alias("problematic_positions"),
        F.when(F.size(of("_fails")) > 0, F.array_join(of("_fails"), ", ")).otherwise(NONE).alias("anchor_fails"), *[F.struct(F.array(*[F.lit(m) for m in names_]).cast("array<string>").alias("algorithms"), told(f"{name}_MT").alias("MT"), told(f"{name}_WT").alias("WT")).alias(name) for name, (names_, _) in calls.items()],
        F.coalesce(shared["wt"], missing).alias("wt_peptide"),
    )
    least = F.array_min(F.transform(F.map_values(of("_by")), lambda v: v["ic50_MT"]))
    place = F.struct((shared["problem"] != NONE).cast("int").alias("a"), (F.size(of("_fails")) > 0).cast("int").alias("b"), F.coalesce(least, F.lit(float("inf"))).alias("c"), of("_peptide").alias("d"))
    return place, detail


def peptide_details(df: DataFrame, keys: list[str], transcript: str, alleles: list[str], order: list[str], algorithms: list[str], elution: list[str] = [], prefix: str = "Median", anchor: str | None = None) -> DataFrame:  # noqa: B006
    """(keys, transcript, peptide, place, detail): what the object tells of each transcript's peptide.

    Of several rows of an allele the last in ``order`` counts, of what all rows
    share the first. Lists follow the sorted ``alleles``: "X" where the peptide has
    no row for the allele, "NA" where a value isn't there. ``anchor``: a boolean
    column; alleles that fail it are named.
    """
    calls = _calls(algorithms, elution)
    place, detail = _told(F.col, alleles, calls)
    rows = _peptides(df.withColumn("_at", F.struct(*[col(c) for c in order])), keys, transcript, calls, prefix, anchor)
    return rows.select(*[col(k) for k in keys], F.col("_transcript").alias("transcript"), F.col("_peptide").alias("peptide"), place.alias("place"), detail.alias("detail"))


def metrics_objects(included: DataFrame, best: DataFrame, keys: list[str], transcript: str, alleles: list[str], order: list[str], algorithms: list[str], elution: list[str] = [], prefix: str = "Median", anchor: str | None = None, allow_incomplete: bool = False) -> DataFrame:  # noqa: B006
    """(keys, json): one object a variant, from the rows that its report is made from and its best row.

    ``good_binders`` has the transcript sets by name; a set's peptides, those of its
    first transcript, stand in the order without problem, anchor pass, least score.
    Rows are dealt by variant once, and all groups are made where they lie. Nothing
    passes the driver: the objects are rows, to be written as text.
    """
    fields = [c for c in ("MANE Select", "Canonical", "Transcript Support Level", "Biotype", "Transcript CDS Flags", "Transcript Length", "Transcript Expression") if c in included.columns]
    calls = _calls(algorithms, elution)
    rows = spread(included, *keys).withColumn("_at", F.struct(*[col(c) for c in order]))
    each = _peptides(rows, keys, transcript, calls, prefix, anchor, set_line(included, transcript, fields, allow_incomplete))
    # the transcript of a set that comes first stands for it; only its peptides are told
    sets = sets_of(each, keys, ["_peptide", "_by", "_fails", "_shared"])

    def entry(p: Column) -> Column:
        place, detail = _told(lambda f: p[f], alleles, calls)
        return F.struct(place.alias("place"), p["_peptide"].alias("peptide"), F.to_json(detail).alias("detail"))

    sets = sets.withColumn("_p", F.array_sort(F.transform("_carried", entry)))
    shown = {"MANE Select": "mane_select", "Canonical": "canonical", "Transcript Support Level": "tsl", "Biotype": "biotype", "Transcript CDS Flags": "transcript_cds_flags", "Transcript Length": "transcript_length"}
    of = lambda f: F.transform("transcripts", lambda x: x[f])
    expression = F.transform("transcripts", lambda x: _quoted(x["Transcript Expression"])) if "Transcript Expression" in fields else F.transform("transcripts", lambda x: F.parse_json(F.lit('"NA"')))
    body = F.struct(of("name").alias("transcripts"), expression.alias("transcript_expr"), *[of(f).alias(n) for f, n in shown.items() if f in fields], "transcript_count", "peptide_count", "total_expr")
    number_of = F.split_part("set", F.lit(" "), F.lit(3)).cast("int")
    listed = sets.groupBy(*[col(k) for k in keys]).agg(F.array_sort(F.collect_list(F.struct(number_of.alias("i"), "set", "transcript_count", "peptide_count", "total_expr", _led_by("peptides", _object(F.col("_p"), "peptide", "detail"), body).alias("body")))).alias("_s"))
    each = lambda f: F.transform("_s", lambda x: x[f])
    here = lambda c: number(c) if c in best.columns else F.lit(None).cast("double")
    own_best = best.select(*[col(k) for k in keys], *[_quoted(here(c)).alias(n) for n, c in (("DNA VAF", "Tumor DNA VAF"), ("RNA VAF", "Tumor RNA VAF"), ("gene_expr", "Gene Expression"))], col("MT Epitope Seq").alias("best_peptide_mt"), F.coalesce(col("WT Epitope Seq"), F.lit("NA")).alias("best_peptide_wt"), col("HLA Allele").alias("best_hla_allele"))
    whole = F.struct(each("set").alias("sets"), each("transcript_count").alias("transcript_counts"), each("peptide_count").alias("peptide_counts"), each("total_expr").alias("set_expr"), col("DNA VAF"), col("RNA VAF"), "gene_expr", "best_peptide_mt", "best_peptide_wt", "best_hla_allele")
    return listed.join(own_best, keys).select(*[col(k) for k in keys], _led_by("good_binders", _object(F.col("_s"), "set", "body"), whole).alias("json"))


def write_metrics(objects: DataFrame, keys: list[str], path: str) -> None:
    """Objects as lines of JSON, each with its variant's ``ID``, the keys joined by dashes."""
    name = F.concat_ws("-", *[col(k).cast("string") for k in keys])
    objects.select(F.concat(F.lit('{"ID":'), _name(name), F.lit(',"metrics":'), "json", F.lit("}"))).write.text(path)
