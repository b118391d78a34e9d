"""From predictions to epitope tables: predictors, wild-type matching, summaries over methods."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from neolake.functions.filters import col
from neolake.functions.sequences import core_position, matches, mutated_positions, places
from neolake.shipping import ship
from neolake.storage import spread, stored

#: A predictor takes pandas frames of (allele, length, epitope) and gives them back with (score, percentile).
Predictor = Callable[[pd.DataFrame], pd.DataFrame]
_predictors: dict[str, Predictor] = {}
#: Ids of sequences that are sent to all executors (64 MB).
HELD = 8_000_000
RESULT = "allele string, length int, epitope string, method string, score double, percentile double"


def register(name: str, predictor: Predictor) -> None:
    _predictors[name] = predictor


def registered() -> list[str]:
    return sorted(_predictors)


def predict(peptides: DataFrame, methods: list[str], parts: int | None = None) -> DataFrame:
    """Long scores of the distinct (allele, length, epitope) by each method; a peptide is predicted once however often it occurs."""
    ship(peptides.sparkSession)
    once = peptides.select("allele", "length", "epitope").distinct()
    once = once.repartition(parts, "allele", "length") if parts else once.repartition("allele", "length", "epitope")
    out = None
    for m in methods:
        call = _predictors[m]

        def run(frames: Iterator[pd.DataFrame], call: Predictor = call, m: str = m) -> Iterator[pd.DataFrame]:
            for f in frames:
                got = call(f)
                yield got.assign(method=m)[[c.split()[0] for c in RESULT.split(", ")]]

        part = once.mapInPandas(run, RESULT)
        out = part if out is None else out.union(part)
    return out


def normalised(raw: DataFrame) -> DataFrame:
    """Predictor output with ``position`` and ``percentile`` under one name: start moved from a core peptide, first percentile field that is there."""
    text = lambda c: F.nullif(F.nullif(F.nullif(F.col(c).cast("string"), F.lit("None")), F.lit("")), F.lit("NA"))
    ranks = [text(c) for c in ("percentile", "percentile_rank", "rank") if c in raw.columns]
    position = core_position(F.col("start").cast("int"), F.col("core_peptide"), F.col("peptide")) if "core_peptide" in raw.columns else F.col("start").cast("int")
    return raw.withColumn("position", position).withColumn("percentile", (F.coalesce(*ranks) if ranks else F.lit(None)).try_cast("double"))


def joined_to_ids(predictions: DataFrame, sequences: DataFrame) -> DataFrame:
    """A prediction for each id of its sequence; ``sequences``: number, ids.

    The result is as large as predictions times ids. Predictions are dealt over all
    cores, stay where they are, and meet whole lists of ids, which are unfolded as rows
    are put out: nothing larger than the inputs is shuffled or held. Up to ``HELD`` ids
    go to all executors; of more, each share of the predictions gets its own lists.
    """
    lists = stored(sequences.select(F.col("number").alias("seq_num"), "ids"), "ids")
    n = lists.agg(F.sum(F.size("ids").cast("long"))).first()[0] or 0
    if n <= HELD:
        both = spread(predictions).join(F.broadcast(lists), "seq_num")
    else:  # dealt by shares too: no name's predictions in one task, however many there are
        key, shares = ["seq_num", "_share"], predictions.sparkSession.sparkContext.defaultParallelism
        every = lists.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
        dealt = predictions.withColumn("_share", (F.monotonically_increasing_id() % shares).cast("int"))
        both = spread(dealt, *key).join(spread(every, *key).hint("merge"), key).drop("_share")
    return both.select("*", F.explode("ids").alias("index")).drop("ids")


def joined_to_variants(predictions: DataFrame, variants: DataFrame, check: bool = True) -> DataFrame:
    """Inner join on ``index``; a repeated index is an error of the run that meets it."""
    if check:
        n = F.count("*").over(Window.partitionBy("index"))
        again = F.raise_error(F.concat(F.lit("the variants repeat the index "), F.col("index").cast("string")))
        variants = variants.withColumn("_n", n).where(F.when(F.col("_n") > 1, again.cast("boolean")).otherwise(F.lit(True))).drop("_n")
    return predictions.join(variants, "index")


def enough_alike(mutant: Column, wildtype: Column) -> Column:
    return matches(mutant, wildtype) >= F.ceil(F.length(mutant) / 2)


def match_wildtype(mutant: DataFrame, wildtype: DataFrame, strict: bool = False) -> DataFrame:
    """Each mutant epitope with the wild-type one at its place: (index, allele, length, position, epitope, variant_type, shift).

    ``wildtype``: index, allele, length, position, epitope. Substitutions and
    frameshifts take the same position. In-frame indels take the same position
    as long as it is at least as like as the one ``shift`` residues on (the
    length of the indel); from the first position where that is more alike, all
    later ones take it. A wild type with under half of its residues in place is
    none. Mutants equal to their wild type are left out. ``strict``: a
    substitution without a wild-type position is an error.
    """
    key = ["index", "allele", "length"]
    # exploded rows are many more than a file's size tells: never broadcast
    same = wildtype.select(*key, F.col("position"), F.col("epitope").alias("wt_left")).hint("merge")
    moved = wildtype.select(*key, F.col("position").alias("_moved"), F.col("epitope").alias("wt_right")).hint("merge")
    df = mutant.join(same, [*key, "position"], "left").withColumn("_moved", F.col("position") + F.col("shift"))
    df = df.join(moved, [*key, "_moved"], "left")
    indel = F.col("variant_type").isin("inframe_ins", "inframe_del")
    like = lambda w: F.coalesce(matches(F.col("epitope"), F.col(w)), F.lit(-1))
    turn = (indel & (like("wt_right") > like("wt_left"))).cast("int")
    onward = Window.partitionBy(*key).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("_turned", F.max(turn).over(onward))
    found = F.when(F.col("_turned") == 1, F.col("wt_right")).otherwise(F.col("wt_left"))
    if strict:
        missing = (F.col("variant_type") == "missense") & found.isNull()
        found = F.when(missing, F.raise_error(F.lit("a substitution has no wild-type epitope at its place"))).otherwise(found)
    df = df.withColumn("wt_epitope", F.when(enough_alike(F.col("epitope"), found), found))
    df = df.withColumn("_found", found).where(~F.col("epitope").eqNullSafe(F.col("_found")))
    return df.withColumn("mutation_position", mutated_positions(F.col("epitope"), F.col("wt_epitope"))).drop("wt_left", "wt_right", "_moved", "_turned", "_found")


def fold_change(wildtype: Column, mutant: Column) -> Column:
    """Wild type over mutant; infinite for a mutant score of 0, null without a wild type."""
    return F.when(wildtype.isNull() | mutant.isNull(), None).when(mutant == 0, F.lit(float("inf"))).otherwise(wildtype / mutant)


def summarise(scores: DataFrame, keys: list[str]) -> DataFrame:
    """Best and median over methods of long scores (keys, method, score, wt_score, percentile, wt_percentile).

    Equal best scores go to the first method by name; the wild-type value is that
    of the winning method, and percentiles have a winner of their own.
    """

    def best(value: str, wt: str, name: str) -> list[Column]:
        by = F.when(F.col(value).isNotNull(), F.struct(value, "method"))
        return [F.min(by).getField(value).alias(f"best_{name}"), F.min(by).getField("method").alias(f"best_{name}_method"), F.min_by(wt, by).alias(f"corresponding_wt_{name}")]

    out = scores.groupBy(*keys).agg(
        *best("score", "wt_score", "score"), *best("percentile", "wt_percentile", "percentile"), F.median("score").alias("median_score"), F.median("wt_score").alias("median_wt_score"), F.median("percentile").alias("median_percentile"), F.median("wt_percentile").alias("median_wt_percentile"),
    )
    return out.withColumns({"corresponding_fold_change": fold_change(F.col("corresponding_wt_score"), F.col("best_score")), "median_fold_change": fold_change(F.col("median_wt_score"), F.col("median_score"))})


def widened(scores: DataFrame, keys: list[str], methods: list[str]) -> DataFrame:
    """A column pair for each method, named as in the exported table."""
    wide = scores.groupBy(*keys).pivot("method", methods).agg(F.first("wt_score").alias("WT IC50 Score"), F.first("score").alias("MT IC50 Score"))
    return wide.withColumnsRenamed({f"{m}_{x}": f"{m} {x}" for m in methods for x in ("WT IC50 Score", "MT IC50 Score")})


def lengthened(wide: DataFrame, keys: list[str], methods: list[str], value: str = "IC50 Score") -> DataFrame:
    """The reverse: (keys, method, score)."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("method"), col(f"{m} {value}").try_cast("double").alias("score")) for m in methods])).alias("x")
    return wide.select(*[col(k) for k in keys], each).select(*[col(k) for k in keys], "x.method", "x.score").where("score is not null")


def alpha_beta_pairs(alpha: DataFrame, beta: DataFrame, valid: DataFrame) -> DataFrame:
    """Class II pairs of alpha and beta alleles of one locus that are valid: (allele) as ``alpha-beta``."""
    locus = lambda c: F.regexp_extract(c, r"^(?:HLA-)?(D[A-Z])", 1)
    a = alpha.select(F.col("allele").alias("a"), locus(F.col("allele")).alias("locus"))
    b = beta.select(F.col("allele").alias("b"), locus(F.col("allele")).alias("locus"))
    return a.join(b, "locus").select(F.concat_ws("-", "a", "b").alias("allele")).join(valid.select("allele").distinct(), "allele", "left_semi")


def methods_of_alleles(support: DataFrame) -> DataFrame:
    return support.groupBy("allele").agg(F.array_sort(F.collect_set("method")).alias("methods"), F.array_sort(F.collect_set("length")).alias("lengths"))


def best_cleavage(sites: DataFrame, keys: list[str]) -> DataFrame:
    """Best cleavage position in an epitope, its score and all ``pos:score`` by position; first position of equal scores."""
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "score"))), lambda s: F.concat_ws(":", s["position"].cast("string"), s["score"].cast("string"))), ",")
    best = F.max(F.struct("score", (-F.col("position")).alias("p")))
    return sites.groupBy(*keys).agg((-best["p"]).alias("Best Cleavage Position"), best["score"].alias("Best Cleavage Score"), listed.alias("Cleavage Sites"))


def species_of_allele(alleles: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The species whose prefix the allele starts with; no prefix or several is an error."""
    starts = F.explode(F.transform(places(F.length("allele")), lambda i: F.substr("allele", F.lit(1), i))).alias("prefix")
    hits = alleles.select("allele", starts).join(prefixes, "prefix", "left")
    one = hits.groupBy("allele").agg(F.collect_set("species").alias("s"))
    return one.select("allele", F.when(F.size("s") == 1, F.col("s")[0]).otherwise(F.raise_error(F.concat(F.lit("no single species for "), F.col("allele")))).alias("species"))


def method_support(spark: SparkSession, rows: list[tuple[str, str, int]]) -> DataFrame:
    return spark.createDataFrame(rows, "method string, allele string, length int")


# --- methods with several scores -----------------------------------------------------------

# The fields of predictors with scores or percentiles of their own, by what they're called in the tables.
PRESENTATION = {"scores": {"mhcflurry_processing_score": "mhcflurry_processing_score", "mhcflurry_presentation_score": "mhcflurry_presentation_score"}, "percentiles": {"mhcflurry_presentation_percentile": "mhcflurry_presentation_percentile"}}
NAMED_SCORE = {"deepimmuno": "immunogenicity", "bigmhc_el": "BigMHC_EL", "bigmhc_im": "BigMHC_IM", "netmhcpan_el": "score"}


def method_values(method: Column, fields: Column, presentation: str = "none") -> Column:
    """Struct (scores, percentiles): maps from the kind of a predictor's value to it, of an output row given as a map from field to text.

    Most methods have an ``ic50`` and one percentile, elution and immunogenicity
    methods a ``score``. ``presentation`` tells which of its values MHCflurry is asked
    for: ``none`` (binding), ``only``, or ``both``. A percentile that isn't there is a
    null in the map; an elution method without any field of its own is an error.
    """
    name = F.lower(method)
    of = lambda c: F.try_element_at(fields, F.lit(c)).try_cast("double")
    pairs = lambda d: [x for k, c in d.items() for x in (F.lit(k), of(c))]
    own = {"none": {"ic50": "ic50"}, "only": PRESENTATION["scores"], "both": {"ic50": "ic50"} | PRESENTATION["scores"]}[presentation]
    ranks = {"none": {"percentile": "percentile"}, "only": PRESENTATION["percentiles"], "both": {"percentile": "percentile"} | PRESENTATION["percentiles"]}[presentation]
    elution = F.coalesce(of("score"), of("ic50"))
    missing = F.raise_error(F.concat(F.lit("no score in the output of "), method)).cast("double")
    scores = F.when(name == "mhcflurry", F.create_map(*pairs(own)))
    for k, c in NAMED_SCORE.items():
        scores = scores.when(name == k, F.create_map(F.lit("score"), of(c)))
    scores = scores.when(F.contains(name, F.lit("netmhciipan_el")), F.create_map(F.lit("score"), F.coalesce(elution, missing))).otherwise(F.create_map(F.lit("ic50"), of("ic50")))
    has = lambda c: F.map_contains_key(fields, c)
    rank = F.when(has("percentile"), of("percentile")).when(has("percentile_rank"), of("percentile_rank")).otherwise(of("rank"))
    percentiles = F.when(name == "mhcflurry", F.create_map(*pairs(ranks))).otherwise(F.create_map(F.lit("percentile"), rank))
    return F.struct(scores.alias("scores"), percentiles.alias("percentiles"))


def summarise_maps(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Best and median of long rows (keys, method, scores, percentiles, wt_scores, wt_percentiles) with maps of values.

    Binding scores (``ic50``) count for the score; for the percentile all of a
    method's percentiles do, flattened, so that a method with two has two votes in
    the median. The best percentile's method is the one it is of, and the wild type's
    is the value of the same kind. Equal best values go to the first method, then kind.
    """
    def flat(c: str) -> DataFrame:
        kinds = F.map_keys(c) if c == "percentiles" else F.filter(F.map_keys(c), lambda k: k == "ic50")
        each = F.explode(F.transform(kinds, lambda k: F.struct(F.try_element_at(c, k).alias("v"), F.col("method").alias("method"), k.alias("kind"), F.try_element_at(f"wt_{c}", k).alias("wt")))).alias("x")
        return rows.select(*keys, each).select(*keys, "x.*")

    def best(df: DataFrame, name: str) -> DataFrame:
        first = F.min(F.when(F.col("v").isNotNull(), F.struct("v", "method", "kind", "wt")))
        out = df.groupBy(*keys).agg(first.alias("_b"), F.median("v").alias(f"median_{name}"), F.median("wt").alias(f"median_wt_{name}"))
        return out.select(*keys, F.col("_b.v").alias(f"best_{name}"), F.col("_b.method").alias(f"best_{name}_method"), F.col("_b.wt").alias(f"corresponding_wt_{name}"), f"median_{name}", f"median_wt_{name}")

    out = rows.select(*keys).distinct().join(best(flat("scores"), "score"), keys, "left").join(best(flat("percentiles"), "percentile"), keys, "left")
    return out.withColumns({"corresponding_fold_change": fold_change(F.col("corresponding_wt_score"), F.col("best_score")), "median_fold_change": fold_change(F.col("median_wt_score"), F.col("median_score"))})
