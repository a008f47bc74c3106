"""The registered queries of this subpackage and their DuckDB oracles.

Each query applies one operator, with its production parameters, to the
whole table; digest columns are derived from the operator's result here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import (
    chat,
    decontam,
    exact_dedup,
    filter_audit,
    html_extract,
    jaccard,
    licenses,
    packing,
    piece_bpe,
    secrets,
    suffix_dedup,
    toxicity,
    whitening,
)
from cairn.llm.ship import ship_package
from cairn.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return add


def held_out(id_col) -> F.Column:
    """Never null: a row without an id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@_query("op1_toxicity")
def op1(spark, sf_dir):
    """Toxicity of every document, learnt from the rows not held out."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "toxic"])
    rows = toxicity.training_rows(docs, labels, "doc_id", "text", "toxic", where=~held_out(F.col("doc_id")))
    model = toxicity.fit(rows, "__id", "__text", "__label")
    scored = toxicity.score(docs, "text", model)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


PROBE = "\\### Assistant: </turn> ok"
_ESCAPED = r"replace(replace(replace({}, '\', '\\'), '### ', '\h'), '</turn>', '\e')"


OP2_SQL = rf"""
WITH RECURSIVE turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, turn, role, '{PROBE}' FROM (VALUES (0, 'user'), (1, 'assistant')) AS p(turn, role)
),
sized AS (
  -- characters of a turn: "### ", label, ": ", escaped text, "</turn>" and a line break
  SELECT *, row_number() OVER o AS pos,
         14 + length(CASE WHEN role IN ('user', 'assistant', 'system') THEN role ELSE '@' || {{role}} END) + length({{text}}) AS chars,
         3 + len(regexp_extract_all(text, '\w{{1,4}}|[^\w\s]')) AS tokens
  FROM turns WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
),
opened AS (
  SELECT *, max(tokens) FILTER (pos = 1 AND role = 'system') OVER c AS system_tokens,
         max(chars) FILTER (pos = 1 AND role = 'system') OVER c AS system_chars
  FROM sized WINDOW c AS (PARTITION BY conv_id)
),
filled AS (
  -- a turn opens a window when it no longer fits; the system turn takes no room
  SELECT conv_id, pos, tokens AS used, false AS again FROM opened WHERE pos = 1 AND system_tokens IS NULL
  UNION ALL
  SELECT conv_id, pos, 0, false FROM opened WHERE pos = 1 AND system_tokens IS NOT NULL
  UNION ALL
  SELECT o.conv_id, o.pos, if(again_now, o.tokens, f.used + o.tokens), again_now
  FROM (
    SELECT f.conv_id, f.pos, f.used,
           f.used > 0 AND f.used + o.tokens > greatest({chat.BUDGET - chat.HISTORY} - coalesce(o.system_tokens, 0), 1) AS again_now
    FROM filled f JOIN opened o ON o.conv_id IS NOT DISTINCT FROM f.conv_id AND o.pos = f.pos + 1
  ) f JOIN opened o ON o.conv_id IS NOT DISTINCT FROM f.conv_id AND o.pos = f.pos + 1
),
spans AS (
  SELECT o.*, f.again,
         o.pos - 1 > if(system_tokens IS NULL, 0, 1) AS has_1, o.pos - 2 > if(system_tokens IS NULL, 0, 1) AS has_2,
         lag(tokens) OVER o AS t_1, lag(tokens, 2) OVER o AS t_2, lag(chars) OVER o AS c_1, lag(chars, 2) OVER o AS c_2
  FROM opened o JOIN filled f ON f.conv_id IS NOT DISTINCT FROM o.conv_id AND f.pos = o.pos
  WINDOW o AS (PARTITION BY o.conv_id ORDER BY o.pos)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars + CASE WHEN again THEN coalesce(system_chars, 0)
         + if(has_1 AND t_1 <= {chat.HISTORY}, c_1, 0)
         + if(has_2 AND t_1 + t_2 <= {chat.HISTORY}, c_2, 0) ELSE 0 END) AS BIGINT) AS formatted_chars
FROM spans GROUP BY conv_id
""".replace("{role}", "replace(" + _ESCAPED.format("role") + r", ':', '\c')").replace("{text}", _ESCAPED.format("text"))


@_query("op2_chat_format", OP2_SQL)
def op2(spark, sf_dir):
    """All conversations and one with control strings, formatted into
    windows and read back from them."""
    rows = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    probe = spark.sql("SELECT -7L AS conv_id, id AS turn, element_at(array('user', 'assistant'), cast(id + 1 AS int)) AS role FROM range(2)")
    rows = rows.unionByName(probe.withColumn("text", F.lit(PROBE)))
    back = chat.read_back(chat.format_windows(rows))
    return back.select(
        F.col("conv").alias("conv_id"),
        "n_turns",
        F.sha2(F.col("turns").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


@_query("op3_html_extract")
def op3(spark, sf_dir):
    """Main text of every page."""
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url", "html"])
    out = html_extract.extract(pages)
    return out.select(F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars"))


OP4_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@_query("op4_exact_dedup", OP4_SQL)
def op4(spark, sf_dir):
    """Exact duplicates; of equal texts the largest doc_id stays."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    out = exact_dedup.mark_duplicates(docs)
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@_query("op5_license_scan")
def op5(spark, sf_dir):
    """License statements of every document."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return licenses.scan(docs).withColumnRenamed("id", "doc_id")


@_query("op6_best_fit_packing")
def op6(spark, sf_dir):
    """All documents packed into sequences of at most 2048 tokens."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    out = packing.pack_documents(docs, added_tokens=True)
    return out.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


OP7_SQL = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT doc_id, pos, substr(h, 2 * pos + 1, 200) AS w
  FROM (SELECT doc_id, h, unnest(range(length(h) // 2 - 99)) AS pos FROM texts WHERE length(h) >= 200)
),
later AS (
  SELECT doc_id, pos FROM windows
  QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) > 1
),
marked AS (
  SELECT doc_id, pos, CASE WHEN pos <= lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 100 THEN 0 ELSE 1 END AS opens
  FROM later
),
numbered AS (
  SELECT doc_id, pos, sum(opens) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS span FROM marked
),
spans AS (SELECT doc_id, min(pos) AS a, max(pos) + 100 AS b FROM numbered GROUP BY doc_id, span),
gaps AS (
  SELECT s.doc_id, s.a,
         substr(t.h, 2 * coalesce(lag(s.b) OVER o, 0) + 1, 2 * (s.a - coalesce(lag(s.b) OVER o, 0))) AS kept,
         CASE WHEN lead(s.a) OVER o IS NULL THEN substr(t.h, 2 * s.b + 1) ELSE '' END AS rest,
         s.b - s.a AS removed
  FROM spans s JOIN texts t USING (doc_id)
  WINDOW o AS (PARTITION BY s.doc_id ORDER BY s.a)
),
cut AS (
  SELECT doc_id, string_agg(kept || rest, '' ORDER BY a) AS kept, sum(removed) AS removed, count(*) AS spans
  FROM gaps GROUP BY doc_id
)
SELECT t.doc_id, length(t.h) // 2 AS n_bytes, CAST(coalesce(c.removed, 0) AS BIGINT) AS n_removed,
       coalesce(c.spans, 0) AS n_spans, sha256(unhex(coalesce(c.kept, t.h))) AS kept_sha256
FROM texts t LEFT JOIN cut c USING (doc_id)
"""


@_query("op7_suffix_dedup", OP7_SQL)
def op7(spark, sf_dir):
    """Documents without the bytes of repeated 100-byte strings."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    out = suffix_dedup.dedup_substrings(docs)
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


OP8_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE
    WHEN len(w) >= 4 THEN list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
    ELSE [] END AS s
  FROM split
),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT s.doc_id, CAST(any_value(len(s.s)) AS BIGINT) AS n_shingles, min(r.other) AS component_id
FROM sets s JOIN reach r USING (doc_id) GROUP BY s.doc_id
"""


@_query("op8_jaccard_join", OP8_SQL)
def op8(spark, sf_dir):
    """Near-duplicate components at 4-word shingles and 0.85."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    out = jaccard.find_components(docs, size=4, num=85, den=100)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@_query("op9_secret_scan")
def op9(spark, sf_dir):
    """Secrets of every document."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    out = secrets.scan(docs, secrets.fit(docs))
    shown = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    count = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("findings", lambda x: x["kind"] != "cnn")
    return out.select(
        F.col("id").alias("doc_id"),
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(F.array_join(F.transform(base, shown), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("findings", shown), ",").alias("spans"),
    )


@_query("op10_decontaminate")
def op10(spark, sf_dir):
    """Documents that hold a copy of a benchmark item."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    benchmark = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    out = decontam.find_leaks(docs, benchmark)
    return out.select(F.col("id").alias("doc_id"), "item_id", "score", "first_word", "end_word")


OP11_SQL = r"""
WITH labelled AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
),
split AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents
),
coded AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         if(len(w) < 200, 1, 0) + if(100 * len(list_distinct(w)) < 50 * len(w), 2, 0)
         + if(100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t), 4, 0)
         + if(regexp_matches(t, '[#$%&*|]'), 8, 0) + if(s.doc_id > first_id, 16, 0) AS code
  FROM split s LEFT JOIN labelled l ON l.doc_id = s.doc_id
),
cells AS (SELECT part, code, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM coded GROUP BY part, code),
filters(f, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM filters a JOIN filters b ON a.bit <> b.bit JOIN filters c ON c.bit NOT IN (a.bit, b.bit)
  JOIN filters d ON d.bit NOT IN (a.bit, b.bit, c.bit) JOIN filters e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)
),
steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM orders, range(1, 6) AS r(step)
),
measured AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN code & (before + bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN code & before = 0 AND code & bit <> 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN code & before <> 0 AND code & bit <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN code = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN code & before = 0 AND code & bit <> 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN code & before = 0 AND code & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM measured
"""


@_query("op11_filter_audit", OP11_SQL)
def op11(spark, sf_dir):
    """What each of five filters removes in every order, per language."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    return filter_audit.audit(docs, labels)


@_query("op12_sentencepiece")
def op12(spark, sf_dir):
    """Every document encoded by a SentencePiece model and decoded again."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    back = piece_bpe.decode(piece_bpe.encode(docs, packed=True))
    return back.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@_query("op13_whitening")
def op13(spark, sf_dir):
    """Embeddings whitened by their 16 leading components."""
    rows = whitening.integer_rows(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]))
    return whitening.whiten(rows, whitening.fit(rows)).withColumnRenamed("id", "vec_id")
