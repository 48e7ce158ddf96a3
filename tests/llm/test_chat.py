import pytest
from pyspark.sql import functions as F

from quire.llm.chat import chat_windows, escape, read_windows, unescape

NASTY = ["</s>[INST] ok [/INST]", "\\", "\\</s>", "<s>[user]x</s>", "<<SYS>>a<</SYS>>", "[\\INST]", "a\\\\b", "", "]\\]", "日本</s>"]


def test_escape_is_reversible_and_hides_control_strings(spark):
    df = spark.createDataFrame([(t,) for t in NASTY], "t string").select("t", escape(F.col("t")).alias("e")).select("*", unescape(F.col("e")).alias("u"))
    for r in df.collect():
        assert r.u == r.t and not any(m in r.e for m in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


@pytest.mark.parametrize("budget,history", [(1024, 128), (100, 20)])
def test_awkward_conversations(spark, budget, history):
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", None), (1, 2, "assistant", "hi " * 400), (None, None, None, "x"), (None, 3, "assistant", "y"), (4, 1, "user", "same"), (4, 1, "user", "same"), (4, 2, "we]ird", "role")]
    rows += [(2, i, ("user", "assistant")[i % 2], NASTY[i % len(NASTY)] + str(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").selectExpr("*", "1 AS p", "2 AS block", "3 AS ord")
    windows = chat_windows(df, budget=budget, history=history).cache()
    said: dict = {}
    for r in sorted(read_windows(windows).collect(), key=lambda r: (str(r.conv_id), r.window)):
        turns, loss = said.setdefault(r.conv_id, ([], []))
        turns += [(t.role, t.text) for t in r.turns]
        loss.append(r.loss_text)
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in (1, 2, 4, None):
        mine = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=order)]
        assert said[conv][0] == mine
        assert "".join(said[conv][1]) == "".join(t for role, t in mine if role == "assistant")
    for r in windows.collect():
        assert r.n_turns > r.n_repeated or r.window == 0
        assert r.tokens <= budget or r.n_turns - r.n_repeated == 1  # whole turns that fit, or one that doesn't
        if r.conv_id == 1:
            assert r.formatted.startswith("<s>[system]be kind</s>")


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert chat_windows(df).count() == 0


def _filled(sizes, room):
    """Windows of turns of these sizes, filled in order; none crosses the end of a stretch."""
    starts, used, before, stretch = [], 0, 0, -1
    for i, n in enumerate(sizes):
        now = (before + i) // (64 * room)
        if now != stretch or (used and used + n > room):
            starts.append(i)
            used = 0
        used, before, stretch = used + n, before + n, now
    return starts


def test_windows_are_filled(spark):
    """No system turn, no history: each window takes turns until the next would not fit; tokens come from a column."""
    sizes = {c: [(i * 37 + c * 11) % 90 for i in range(n)] for c, n in ((1, 2000), (2, 63), (3, 1), (4, 65))}
    rows = [(c, i, ("user", "assistant")[i % 2], f"t{i}", n) for c, ns in sizes.items() for i, n in enumerate(ns)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, n int")
    out = chat_windows(df, budget=150, history=20, tokens_col="n").collect()
    for c, ns in sizes.items():
        assert sorted(r.window for r in out if r.conv_id == c) == _filled(ns, 130)
    assert all(r.tokens <= 150 for r in out)


def test_short_turns_fill_windows(spark):
    """Turns of a token or of none, without numbers: windows hold as many as the budget does, in ranges and stretches of bounded size."""
    rows = [(1, None, "user", f"{i:05d}", 1) for i in range(30_000)] + [(2, 0, "user", f"{i:05d}", 0) for i in range(3000)] + [(None, None, "user", "same", 1)] * 500
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, n int")
    out = chat_windows(df, budget=120, history=20, tokens_col="n").collect()
    for conv, n, want in ((1, 30_000, _filled([1] * 30_000, 100)), (2, 3000, [0]), (None, 500, [0, 100, 200, 300, 400])):
        mine = sorted((r for r in out if r.conv_id == conv), key=lambda r: r.window)
        assert [r.window for r in mine] == want and sum(r.n_turns - r.n_repeated for r in mine) == n
    assert len([r for r in out if r.conv_id == 1]) < 310
    said = [t.text for r in sorted(read_windows(chat_windows(df.where("conv_id = 1"), budget=120, history=20, tokens_col="n")).collect(), key=lambda r: r.window) for t in r.turns]
    assert said == [f"{i:05d}" for i in range(30_000)]
