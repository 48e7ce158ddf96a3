"""Benchmark rules checked against rendered outputs: an equi-join on the document, then one comparison for each rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.similarity import partial_ratio
from quire.functions.text import bench_normalize


def check_rules(rules: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """Columns: the rule's, ``passed`` and ``reason`` (null if it passed).

    ``rules``: key, type (present, absent, order, baseline), text, before, after, first_n, last_n, max_diffs; ``outputs``: key, md.
    A text is there if a window of the output, or of its first and last characters, differs by ``max_diffs`` at most; an
    order holds if both texts are there and the first starts first; a baseline asks for a letter or digit. Texts that a rule's
    type doesn't use are null and not searched.
    """
    j = rules.join(outputs.select(key, F.col("md"), bench_normalize(F.col("md")).alias("page")), key)
    whole = F.coalesce("first_n", "last_n").isNull()
    cut = F.concat(F.when(F.col("first_n") > 0, F.left("page", F.col("first_n"))).otherwise(""), F.when(F.col("last_n") > 0, F.right("page", F.col("last_n"))).otherwise(""))
    least = lambda q: 100.0 - 100.0 * F.coalesce("max_diffs", F.lit(0)) / F.greatest(F.char_length(q), F.lit(1))
    searches = F.col("type").isin("present", "absent")
    q = {c: F.when(searches if c == "text" else F.col("type") == "order", bench_normalize(F.col(c))) for c in ("text", "before", "after")}
    j = j.withColumns({"q_text": q["text"], "q_before": q["before"], "q_after": q["after"], "hay": F.when(whole, F.col("page")).otherwise(cut)})
    j = j.withColumns({
        "m_text": partial_ratio(F.col("q_text"), F.when(F.col("q_text").isNotNull(), F.col("hay")), least(F.col("q_text"))),
        "m_before": partial_ratio(F.col("q_before"), F.when(F.col("q_before").isNotNull(), F.col("page")), least(F.col("q_before"))),
        "m_after": partial_ratio(F.col("q_after"), F.when(F.col("q_after").isNotNull(), F.col("page")), least(F.col("q_after"))),
    })
    there = lambda c: F.col(f"m_{c}.start") >= 0
    reason = (
        F.when((F.col("type") == "present") & ~there("text"), "text not found").when((F.col("type") == "absent") & there("text"), "text found")
        .when((F.col("type") == "order") & ~there("before"), "before not found").when((F.col("type") == "order") & ~there("after"), "after not found")
        .when((F.col("type") == "order") & (F.col("m_before.start") >= F.col("m_after.start")), "wrong order")
        .when((F.col("type") == "baseline") & ~F.coalesce("md", F.lit("")).rlike(r"[\p{L}\p{N}]"), "blank page")
    )
    return j.select(*rules.columns, reason.isNull().alias("passed"), reason.alias("reason"))
