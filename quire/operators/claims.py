"""Claims and their citations: quotation matching, verification, scores, wording, duplicates, grading.

All joins are on the cited block, the claim, or (lesson, word); nothing compares every claim with every block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quire.functions.text import bind, id_slug, jaccard, normalize_fa
from quire.session import Scratch

FUZZY_MIN = 0.75


def match_quote(quote: Column, block: Column) -> Column:
    """Struct of matched, score, method, char_start, char_end: exact (1), normalised (0.95), else token overlap."""
    make = lambda ok, score, method, start, size: F.struct(ok.alias("matched"), score.alias("score"), F.lit(method).alias("method"), start.alias("char_start"), (start + size).alias("char_end"))
    none = F.lit(None).cast("int")
    words = lambda t: F.filter(F.split(t, r"\s+"), lambda w: w != "")

    def overlap(x: Column) -> Column:
        share = F.when(F.size(x["said"]) > 0, F.size(F.filter(x["said"], lambda t: F.array_contains(x["have"], t))) / F.size(x["said"]))
        return make(F.coalesce(share >= FUZZY_MIN, F.lit(False)), F.round(F.coalesce(share, F.lit(0.0)), 4), "token_overlap", none, F.lit(0))

    def decide(x: Column) -> Column:
        exact, near = F.position(x["q"], x["b"]), F.position(x["nq"], x["nb"])
        blank = (F.length(F.btrim(x["q"])) == 0) | (F.length(F.btrim(x["b"])) == 0)
        return (
            F.when(blank, make(F.lit(False), F.lit(0.0), "none", none, F.lit(0)))
            .when(exact > 0, make(F.lit(True), F.lit(1.0), "exact", exact - 1, F.char_length(x["q"])))
            .when(near > 0, make(F.lit(True), F.lit(0.95), "normalized", near - 1, F.char_length(x["nq"])))
            .otherwise(bind(F.struct(words(x["nq"]).alias("said"), words(x["nb"]).alias("have")), overlap))
        )

    return bind(F.struct(quote.alias("q"), block.alias("b"), normalize_fa(quote).alias("nq"), normalize_fa(block).alias("nb")), decide)


def _evidence() -> list[Column]:
    """Of some citations: how many, how many verified, whether one is word for word, whether all are images."""
    return [
        F.count("*").alias("n_evidence"), F.count_if("matched").alias("n_verified"), F.bool_or(F.col("matched") & F.col("method").isin("exact", "normalized")).alias("exact"),
        F.bool_and(F.col("asset_id").isNotNull()).alias("visual_only"),
    ]


def verify_claims(claims: DataFrame, citations: DataFrame) -> DataFrame:
    """Claim level after its citations: ``citations`` have claim keys, matched, method, asset_id.

    explicit without a verified quotation becomes inferred; explicit on images alone needs a visual review.
    """
    return claim_levels(claims.join(citations.groupBy("package_id", "id").agg(*_evidence()), ["package_id", "id"], "left"))


def weigh_citations(flagged: DataFrame, *keys: str) -> DataFrame:
    """A row a claim: ``cited`` and ``kept``, the blocks it cites and those of them that are its own, and the evidence of the latter.

    ``flagged``: citations with ``own`` (true or null) and further ``keys``, each the same for one claim and block. Citations are counted by block first, where a join on the block has dealt them.
    """
    block = flagged.groupBy("package_id", "id", *keys, "block_id").agg(F.bool_or("own").alias("own"), *_evidence())
    of_own = lambda c: F.when(F.col("own"), F.col(c))
    return block.groupBy("package_id", "id").agg(
        F.count("*").alias("cited"), F.count("own").alias("kept"), F.sum(of_own("n_evidence")).alias("n_evidence"), F.sum(of_own("n_verified")).alias("n_verified"),
        F.bool_or(of_own("exact")).alias("exact"), F.bool_and(of_own("visual_only")).alias("visual_only"),
    )


def claim_levels(weighed: DataFrame) -> DataFrame:
    """Claims with their evidence: level, whether it is a lower one, and whether there is any evidence."""
    j = weighed.na.fill(0, ["n_evidence", "n_verified"]).na.fill(False, ["exact", "visual_only"])
    explicit = F.col("claimed_level") == "explicit"
    level = F.when(explicit & (F.col("n_verified") == 0), "inferred").when(explicit & F.col("visual_only") & (F.col("n_evidence") > 0), "needs_visual_review").otherwise(F.col("claimed_level"))
    return j.withColumns({"level": level, "demoted": level != F.col("claimed_level"), "grounded": F.col("n_evidence") > 0})


def claim_confidence(verified: DataFrame) -> DataFrame:
    """``confidence``: additive terms, clamped to 0..1 and rounded (half to even) to four digits after each, capped at 0.5 for images."""
    clamp = lambda c: F.bround(F.least(F.lit(1.0), F.greatest(F.lit(0.0), c)), 4)
    any_ok = F.col("n_verified") > 0
    score = clamp(F.when(any_ok & F.col("exact"), 0.55).when(any_ok, 0.35).otherwise(0.0))
    score = clamp(score + F.when(F.col("n_verified") >= 2, 0.10).otherwise(0.0))
    score = clamp(score + F.when((F.col("level") == "explicit") & any_ok, 0.10).otherwise(0.0))
    score = clamp(score + F.when(F.col("density") == "low", -0.10).otherwise(0.0))
    score = clamp(score + F.coalesce(F.least(F.lit(0.10), F.greatest(F.lit(0.0), F.col("model_confidence")) * 0.10), F.lit(0.0)))
    return verified.withColumn("confidence", F.when(F.col("level") == "needs_visual_review", F.least(score, F.lit(0.5))).otherwise(score))


def review_reasons(scored: DataFrame, accept: float = 0.85, queue: float = 0.60) -> DataFrame:
    """``reasons``: ordered short codes of why a person must look; ``needs_review`` if there is any."""
    reasons = F.array_compact(F.array(
        F.when(F.col("level") == "needs_visual_review", F.lit("image")), F.when(F.col("demoted"), F.lit("demoted")), F.when(F.col("n_verified") == 0, F.lit("no_quotation")),
        F.when(F.col("confidence") < queue, F.lit("low")).when(F.col("confidence") < accept, F.lit("below_accept")),
    ))
    return scored.withColumns({"reasons": reasons, "needs_review": F.size(reasons) > 0})


def check_wording(claim_words: DataFrame, lesson_words: DataFrame, least: int = 4, stem: int = 4) -> DataFrame:
    """Claim words that the lesson doesn't vouch for: not the word, nor its first four letters, nor a three-letter word it starts with.

    Three anti-joins on (lesson, word or prefix); ``claim_words``: lesson_id, claim_id, word; ``lesson_words``: lesson_id, word.
    """
    left = claim_words.where(F.length("word") >= least).distinct()
    left = left.withColumns({"s": F.substring("word", 1, stem), "c": F.substring("word", 1, stem - 1)})
    known = lesson_words.select("lesson_id", "word").distinct()
    left = left.join(known, ["lesson_id", "word"], "left_anti")
    left = left.join(known.select("lesson_id", F.substring("word", 1, stem).alias("s")).distinct(), ["lesson_id", "s"], "left_anti")
    return left.join(known.where(F.length("word") == stem - 1).select("lesson_id", F.col("word").alias("c")), ["lesson_id", "c"], "left_anti").select("lesson_id", "claim_id", "word")


def label_words(label: Column) -> Column:
    return F.array_distinct(F.filter(F.split(id_slug(label), " "), lambda w: w != ""))


def first_twin(concepts: DataFrame) -> DataFrame:
    """Concepts with ``duplicate_of``: the first of the lesson's earlier concepts with the same words, of which there is at least one.

    What ``flag_duplicates`` finds at a threshold of 1, without pairs: equal sets of words are one group.
    """
    words = concepts.withColumn("_words", F.array_sort(label_words(F.col("label"))))
    first = F.min("id").over(W.partitionBy("package_id", "lesson_id", "_words"))
    twin = (F.size("_words") > 0) & F.col("lesson_id").isNotNull() & F.col("package_id").isNotNull() & (F.col("_first") < F.col("id"))
    return words.withColumn("_first", first).withColumn("duplicate_of", F.when(twin, F.col("_first"))).drop("_words", "_first")


#: Concepts of a lesson up to which its pairs are made in one row.
IN_ROW = 64


def flag_duplicates(concepts: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs in one lesson whose label words overlap by ``threshold`` (Jaccard); only concepts that share a word meet.

    A lesson of up to ``IN_ROW`` concepts is gathered in a row, so that its labels are shuffled once and cut into words behind the shuffle;
    the rows of larger ones meet by their words (``_by_words``). Lessons are counted first: no larger one is gathered.
    """
    lesson = ["package_id", "lesson_id"]
    given = concepts.select(*lesson, "id", "label").where("package_id is not null and lesson_id is not null and id is not null")
    large = Scratch(concepts.sparkSession, "lessons").keep(given.groupBy(*lesson).agg(F.count("*").alias("n")).where(F.col("n") > IN_ROW).select(*lesson), "large")
    if large.isEmpty():
        return _in_rows(given, threshold)
    return _in_rows(given.join(large, lesson, "left_anti"), threshold).unionByName(_by_words(given.join(large, lesson, "left_semi"), threshold))


def _in_rows(concepts: DataFrame, threshold: float) -> DataFrame:
    """Pairs of lessons that fit a row."""
    lesson = ["package_id", "lesson_id"]
    rows = concepts.groupBy(*lesson).agg(F.collect_list(F.struct("id", "label")).alias("c")).where(F.size("c") > 1)
    rows = rows.select(*lesson, F.transform("c", lambda x: F.struct(x["id"].alias("id"), label_words(x["label"]).alias("ws"))).alias("c"))

    def overlap(a: Column, b: Column) -> Column:
        n = F.size(a) + F.size(b)  # words of a label are distinct
        return bind(F.size(F.array_intersect(a, b)), lambda both: (both > 0) & (both / (n - both) >= threshold))

    later = lambda a: F.filter("c", lambda b: (a["id"] < b["id"]) & overlap(a["ws"], b["ws"]))
    pairs = F.flatten(F.transform("c", lambda a: F.transform(later(a), lambda b: F.struct(a["id"].alias("id_a"), b["id"].alias("id_b")))))
    return rows.select(*lesson, F.explode(F.array_distinct(pairs)).alias("p")).select(*lesson, "p.id_a", "p.id_b")


def _by_words(concepts: DataFrame, threshold: float) -> DataFrame:
    """Pairs of lessons of any size.

    Two sets of that overlap share one of the words that each has fewest of in the lesson: all but as many as the overlap needs, less one.
    So only those meet, and a word that a whole lesson shares makes no pairs.
    """
    words = concepts.select("package_id", "lesson_id", "id", label_words(F.col("label")).alias("ws"))
    words = Scratch(concepts.sparkSession, "labels").keep(words, "words")  # each label is cut into words once
    each = words.select("*", F.explode("ws").alias("w"))
    lesson = ["package_id", "lesson_id"]
    each = each.withColumn("n", F.count("*").over(W.partitionBy(*lesson, "w"))).withColumn("rank", F.dense_rank().over(W.partitionBy(*lesson, "id", "ws").orderBy("n", "w")))
    each = each.where(F.col("rank") <= F.size("ws") - F.ceil(threshold * F.size("ws") - 1e-9) + 1)
    a, b = each.alias("a"), each.alias("b")
    same = (F.col("a.package_id") == F.col("b.package_id")) & (F.col("a.lesson_id") == F.col("b.lesson_id")) & (F.col("a.w") == F.col("b.w")) & (F.col("a.id") < F.col("b.id"))
    pairs = a.join(b, same).where(jaccard(F.col("a.ws"), F.col("b.ws")) >= threshold)
    return pairs.select("a.package_id", "a.lesson_id", F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b")).distinct()


#: Who marks a form of question: fixed values.
GRADING = {
    "multiple_choice": "auto", "true_false": "auto", "fill_blank": "auto", "short_answer": "auto", "long_answer": "manual", "matching": "auto", "ordering": "auto", "grouping": "auto",
    "table_fill": "auto", "column_arithmetic": "auto", "text_selection": "auto", "drawing": "manual", "coloring": "manual", "handwriting": "hybrid", "spoken": "hybrid", "physical_task": "manual",
}


#: Types of activities: a fixed closed list.
ACTIVITY_TYPES = ["explanation", "guided_practice", "practice", "game", "matching", "drag_drop", "sorting", "handwriting", "audio", "visual", "remediation", "review"]


def grading_mode(question_type: Column, explicit: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in GRADING.items() for x in pair])
    return F.coalesce(explicit, F.element_at(known, question_type), F.lit("manual"))


def answer_key(answer: Column, accepted: Column) -> Column:
    """The answer and its accepted spellings, each once."""
    return F.array_distinct(F.filter(F.concat(F.array(answer), F.coalesce(accepted, F.array().cast("array<string>"))), lambda x: x.isNotNull() & (x != "")))
