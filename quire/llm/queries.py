"""The registered queries of this package and, where SQL can express them, their DuckDB texts."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.bpe import bpe_round_trip
from quire.llm.chat import chat_windows, read_windows
from quire.llm.fim import fill_in_middle, frame_texts, output_digests
from quire.llm.langid import identify, learn_languages
from quire.llm.linededup import line_dedup
from quire.llm.media import carve_media, samples_of, sniff_media, text_to_media
from quire.llm.minhash import minhash_groups
from quire.llm.mixing import DOMAIN, mix_to_weights
from quire.llm.packing import pack_pieces, token_pieces
from quire.llm.quality import quality_rules
from quire.llm.runs import periodic_runs
from quire.llm.tokenbin import read_tokens, write_tokens
from quire.llm.warc import read_warc, write_warc
from quire.session import Scratch, table

#: Where the public vocabulary files lie; the same path on every machine.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_groups(table(spark, sf_dir, "documents"), k=3, percent=85)


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
  ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
c(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT c.doc_id, e.b FROM c JOIN e ON c.r = e.a),
m AS (SELECT doc_id, min(r) AS component_id FROM c GROUP BY 1)
SELECT m.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, m.doc_id = component_id AS kept FROM m LEFT JOIN n ON m.doc_id = n.doc_id
"""


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = Scratch(spark, "warc-files").path("archives")
    manifest = write_warc(table(spark, sf_dir, "pages"), folder)
    return read_warc(manifest, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT p.*, CASE WHEN f.first < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.first < p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND p.payload_bytes >= 100
"""


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").selectExpr("doc_id", f"{DOMAIN} AS domain")
    out = mix_to_weights(table(spark, sf_dir, "documents").select("doc_id", "text"), labels, {"clean": 0.95, "low": 0.05, "toxic": 0.0}, anchor="clean", carry=["doc_id"])
    return out.select("row.doc_id", "tokens", *[F.coalesce(F.col("posteriors")[d], F.lit(0.0)).alias(f"p_{d}") for d in ("clean", "low", "toxic")], "rate", "copies")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    fence = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", fence), (-1, 1, "assistant", fence)], "conv_id long, turn int, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("int").alias("turn"), "role", "text").unionByName(probe)
    windows = read_windows(chat_windows(turns))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    part = windows.select("conv_id", F.struct("window", said.alias("said"), F.col("loss_text").alias("loss")).alias("w"), F.size("turns").alias("n"), F.char_length("formatted").alias("c"))
    whole = part.groupBy("conv_id").agg(F.sum("n").cast("long").alias("n_turns"), F.sort_array(F.collect_list("w")).alias("ws"), F.sum("c").cast("long").alias("formatted_chars"))
    text = lambda k: F.array_join(F.transform("ws", lambda w: w[k]), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.encode(text("said"), "UTF-8"), 256).alias("turns_sha256"), F.char_length(text("loss")).cast("long").alias("loss_chars"),
        F.sha2(F.encode(text("loss"), "UTF-8"), 256).alias("loss_sha256"), "formatted_chars",
    )


OP4_SQL = r"""
WITH RECURSIVE t0 AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT *, (length(text) + 3) // 4 + 4 AS tokens, row_number() OVER w - 1 AS ord, first_value(role) OVER w = 'system' AS has_system
  FROM t0 WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
s AS (SELECT *, has_system AND ord = 0 AS is_system, sum(CASE WHEN has_system AND ord = 0 THEN tokens ELSE 0 END) OVER (PARTITION BY conv_id) AS st FROM t),
p AS (SELECT *, CASE WHEN is_system THEN 0 ELSE tokens END AS new, sum(CASE WHEN is_system THEN 0 ELSE tokens END) OVER (PARTITION BY conv_id ORDER BY ord) - CASE WHEN is_system THEN 0 ELSE tokens END AS p,
  greatest(64, 1024 - 128 - st) AS room,
  length(role) + 9 + length(regexp_replace(replace(text, '\', '##'), '(</?s>|<</?SYS>>|\[/?INST\])', '\1#', 'g')) AS size FROM s),
g(conv_id, ord, win, used, stretch) AS (SELECT conv_id, ord, ord, new, 0::BIGINT FROM p WHERE ord = 0
  UNION ALL SELECT p.conv_id, p.ord, CASE WHEN (p.p + p.ord) // (64 * p.room) = g.stretch AND (g.used = 0 OR g.used + p.new <= p.room) THEN g.win ELSE p.ord END,
    CASE WHEN (p.p + p.ord) // (64 * p.room) = g.stretch AND (g.used = 0 OR g.used + p.new <= p.room) THEN g.used + p.new ELSE p.new END, ((p.p + p.ord) // (64 * p.room))::BIGINT
  FROM g JOIN p ON p.conv_id IS NOT DISTINCT FROM g.conv_id AND p.ord = g.ord + 1),
w AS (SELECT p.*, g.win FROM p JOIN g ON p.conv_id IS NOT DISTINCT FROM g.conv_id AND p.ord = g.ord),
f AS (SELECT conv_id, win, min(ord) AS first, min(p) AS first_p FROM w WHERE NOT is_system GROUP BY ALL),
again AS (
  SELECT f.conv_id, w.size FROM f JOIN w ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND NOT w.is_system AND w.ord BETWEEN f.first - 4 AND f.first - 1 AND f.first_p - w.p <= 128
  UNION ALL SELECT f.conv_id, w.size FROM f JOIN w ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND w.is_system AND f.win > 0),
extra AS (SELECT conv_id, sum(size) AS size FROM again GROUP BY 1)
SELECT w.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY ord)) AS turns_sha256,
  length(coalesce(string_agg(text, '' ORDER BY ord) FILTER (WHERE role = 'assistant'), '')) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY ord) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(w.size) + coalesce(any_value(e.size), 0) AS BIGINT) AS formatted_chars
FROM w LEFT JOIN extra e ON w.conv_id IS NOT DISTINCT FROM e.conv_id GROUP BY w.conv_id
"""


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH lines AS (
  SELECT d.doc_id, t.pos, t.line,
    translate(trim(t.line, E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM documents d, LATERAL (SELECT unnest(string_split(coalesce(d.text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(d.text, ''), chr(10)), 1) AS pos) t),
common AS (SELECT k FROM lines WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT l.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE c.k IS NOT NULL) AS n_dropped,
  sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE c.k IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN common c ON l.k = c.k GROUP BY l.doc_id
"""


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    automata = learn_languages(docs.where(~held_out))
    out = identify(docs.select("doc_id", "text"), automata)
    return out.select("row.doc_id", "lang_pred", "score").select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads are stored as wave samples behind a preview, under a declared type that is right, wrong or
    missing; sniffing corrects it and carving gives the wave file back, whose samples are sniffed in turn."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), text_to_media(F.col("text")).alias("media"))
    stored = Scratch(spark, "media").keep(docs, "media")
    declared = F.get(F.array(F.lit("image/png"), F.lit("audio/wav"), F.lit(None)), (F.crc32("media") % 3).cast("int"))
    outer = sniff_media(stored.withColumns({"declared": declared, "media_sha256": F.sha2("media", 256)}))
    named = lambda found: F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["type"], x["offset"], x["length"])), ",")
    said = F.concat_ws(";", "media_type", F.concat(F.lit("corrected="), F.col("corrected")), named(F.col("found")))
    waves = carve_media(outer.withColumn("row", F.col("row").withField("said", said).withField("media_bytes", F.octet_length("media")).dropFields("media"))).where("type = 'audio/wav'")
    inner = sniff_media(waves.select("row.*", samples_of(F.col("carved")).alias("payload")), media_col="payload")
    return inner.select(
        "row.doc_id", "row.n_bytes", F.octet_length("media").cast("long").alias("payload_bytes"), F.sha2("media", 256).alias("payload_sha256"),
        F.crc32(F.substring("media", -16, 16)).alias("tail_crc32"), F.col("row.media_bytes").cast("long").alias("media_bytes"), "row.media_sha256",
        F.concat_ws(";", "row.said", F.concat(F.lit("inside="), named(F.col("found")))).alias("feature"),
    )


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = os.path.join(TOKENIZERS, "word_bpe_49k.json")
    out = table(spark, sf_dir, "documents").select("doc_id", bpe_round_trip(F.col("text"), path).alias("m")).select("doc_id", "m.*")
    return out.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = Scratch(spark, "token-files").path("files")
    manifest = write_tokens(table(spark, sf_dir, "documents"), folder, os.path.join(TOKENIZERS, "byte_bpe_50k.json"), end_id=2)
    return read_tokens(manifest, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    framed = Scratch(spark, "fim").keep(frame_texts(table(spark, sf_dir, "documents"), carry=["doc_id"]), "frames")
    out = fill_in_middle(framed, seed="7", rate=100, spm=50)
    return out.select("row.doc_id", "n", "form", "prefix_chars", "middle_chars", output_digests(F.col("output"), F.col("form")).alias("d")).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "d.*")


OP11_SQL = r"""
WITH u AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units, sha256('7:' || doc_id) AS h FROM documents),
h AS (SELECT *, len(units) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[25:32])::BIGINT AS h4 FROM u),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_pieces(table(spark, sf_dir, "documents"), os.path.join(TOKENIZERS, "word_bpe_49k.json"), end_id=1, capacity=4096, carry=["doc_id"])
    packed = pack_pieces(pieces.select("row.doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), capacity=4096)
    return packed.select("row.*", "sequence_id", "offset")


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document in ten, by a hash of its id, is made periodic from some word on; then the runs of all are found."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = docs.where(h % 10 == 0).select("doc_id", "text", g.alias("g"), F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("words"))
    n = F.size("words")
    cut = words.select("doc_id", "text", "words", n.alias("n"), (F.col("g") % n).alias("a"), "g").withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    at = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    again = F.array_join(F.transform("words", lambda w, i: F.get("words", at(i).cast("int"))), " ")
    periodic = cut.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text"))
    out = periodic_runs(docs.where((h % 10 != 0) | h.isNull()).unionByName(periodic), least=12)
    longest = F.reduce(
        "runs", F.lit(None).cast("struct<start: long, length: long, period: long>"),
        lambda best, r: F.when(best.isNull() | (r["length"] > best["length"]), r).otherwise(best),
    )
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return out.select("row.doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"), listed.alias("listed"), "collapsed").select(
        "doc_id", "n_runs", "top.start", "top.length", "top.period", F.floor(1000 * F.col("top.length") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(F.encode("listed", "UTF-8"), 256).alias("runs_sha256"), F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    )


OP13_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
  xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) AS h FROM documents),
c AS (SELECT doc_id, w, len(w) AS n, h, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
e AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END) ELSE w END AS w FROM c),
t AS MATERIALIZED (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM e),
m AS (SELECT x.doc_id, y.i - x.i AS q, x.i, x.i - row_number() OVER (PARTITION BY x.doc_id, y.i - x.i ORDER BY x.i) AS island
  FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 2 * (y.i - x.i) <= x.n),
s AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM m GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(12, 2 * q)),
r AS (SELECT doc_id, start, length, min(q) AS period FROM s GROUP BY ALL),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
kept AS (SELECT t.doc_id, string_agg(word, ' ' ORDER BY t.i) AS collapsed FROM t ANTI JOIN gone ON t.doc_id = gone.doc_id AND t.i = gone.i GROUP BY 1),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM r GROUP BY 1),
top AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, top.start, top.length, top.period, 1000 * top.length // top.period AS exponent_milli,
  sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN top USING (doc_id)
"""


QUERIES = {
    "op1_minhash": op1_minhash, "op2_warc": op2_warc, "op3_mixing": op3_mixing, "op4_chat": op4_chat, "op5_line_dedup": op5_line_dedup, "op6_langid": op6_langid, "op7_media": op7_media,
    "op8_bpe": op8_bpe, "op9_token_file": op9_token_file, "op10_quality": op10_quality, "op11_fim": op11_fim, "op12_packing": op12_packing, "op13_runs": op13_runs,
}
ORACLES = {"op1_minhash": OP1_SQL, "op2_warc": OP2_SQL, "op4_chat": OP4_SQL, "op5_line_dedup": OP5_SQL, "op11_fim": OP11_SQL, "op13_runs": OP13_SQL}
