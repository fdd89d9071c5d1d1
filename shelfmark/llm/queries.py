"""The registered queries: each operator over its whole table, and SQL where it can tell the same."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import (
    audit, chat, covertree, decontaminate, html_text, mixing, multiindex, neardup, outliers, repeats, sharding, templates,
    tokens,
)

#: Files of public tokenizers; read on the driver and sent to the tasks.
TOKENIZERS = "/opt/tokenizers"
ROOT = str(Path(__file__).resolve().parents[2])


def prepared(spark: SparkSession) -> SparkSession:
    """Let Python workers of this session import the library from where the driver has it."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join([ROOT, *filter(None, paths)])
    return spark


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Eight shards of near equal bytes; equal texts stay together."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    docs = docs.withColumn("text_crc32", F.coalesce(F.crc32(F.encode("text", "UTF-8")), F.lit(0)).cast("long"))
    placed = sharding.shards(docs, count=8, keep=["doc_id", "text_crc32"])
    return placed.select(
        "doc_id", "sharding.size", "text_crc32", F.lit("bytes").alias("law"), "sharding.shard", "sharding.slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of each document, its white space included, by a unigram vocabulary."""
    vocabulary = tokens.unigram_vocabulary(f"{TOKENIZERS}/piece_bpe_32k.model")
    return tokens.token_counts(_table(spark, folder, "documents"), vocabulary, whole=True)


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of each document that lie in a ten-word window of a benchmark item."""
    benchmark = _table(spark, folder, "benchmark")
    found = decontaminate.contamination(_table(spark, folder, "documents"), benchmark, window=10, keep=["doc_id"])
    items = F.col("contamination.items")
    return found.select(
        "doc_id", "contamination.n_words", "contamination.n_hit", F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        (F.col("contamination.n_hit") > 0).alias("contaminated"),
    )


def op4_line_templates(spark: SparkSession, folder: str) -> DataFrame:
    """Each document without the lines of templates that recur across documents."""
    return templates.template_lines(_table(spark, folder, "documents"))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What a mix to target weights takes of each document, and where in the order of training it comes first."""
    mixed = mixing.mix(_table(spark, folder, "documents"), weights=(5, 2, 1), most=3, keep=["doc_id"])
    placed = mixing.positions(mixed)
    taken = F.col("mix.size") * F.size("positions")
    return placed.select(
        "doc_id", "mix.size", "mix.source_size", "mix.target", taken.cast("long").alias("taken"),
        F.get("positions", F.lit(0)).alias("first_position"),
    )


def op6_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Each document without the bytes of 400-byte strings that start anywhere else too."""
    found = repeats.repeats(_table(spark, folder, "documents"), length=400, whole=True)
    kept = F.make_valid_utf8(F.col("kept").cast("string"))  # half a character may be left at the edge of a span
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256", kept.alias("kept")
    )


#: A conversation whose texts look like marks.
TRICKY = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op7_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Formatted conversations, read back from their text and loss mask."""
    tokenizer = Path(f"{TOKENIZERS}/byte_bpe_50k.json").read_text()
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(TRICKY, "conv_id long, turn long, role string, text string"))
    return chat.digests(chat.formatted(rows, tokenizer))


def op8_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of each page."""
    return html_text.extracted(_table(spark, folder, "pages"))


def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents by four-word shingles and a similarity of 0.8."""
    return neardup.near_duplicates(_table(spark, folder, "documents"), width=4, percent=80)


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of each document, the base rules and the verdict of the robust distance."""
    judged = outliers.quality(_table(spark, folder, "documents"), keep=["doc_id"])
    return judged.select("doc_id", *(f"quality.{c}" for c in (*outliers.COUNTS, "base_failed", "kept")))


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What five filters remove from each source in each of their orders."""
    return audit.audit(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op12_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of vectors of one label with a cosine of 0.98 or more."""
    rows = _table(spark, folder, "embeddings")
    return covertree.near_vectors(rows, id="vec_id", label="label", vector="embedding", cosine=0.98)


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of other labels that score half to nearly as much as an anchor's best of its own label."""
    rows = _table(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    rows = rows.where(F.col("label").isNotNull() & covertree.finite("embedding"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    rows = rows.select("vec_id", moved.alias("label"), whole.alias("vector"), (F.col("vec_id") % 50 == 0).alias("anchor"))
    return multiindex.hard_negatives(rows, id="vec_id", positives=5, negatives=3, least=50, most=95)


QUERIES = {
    f.__name__: f
    for f in (
        op1_shards, op2_token_counts, op3_decontamination, op4_line_templates, op5_mixing, op6_repeats, op7_chat,
        op8_main_text, op9_near_duplicates, op10_quality, op11_filter_audit, op12_near_vectors, op13_hard_negatives,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LETTERS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
#: The stretches of the schedules as rows, numbered; the last of each is ``final``.
_STRETCHES = " UNION ALL ".join(
    f"SELECT {k} AS schedule, {i} AS i, {i + 1 == len(parts)} AS final, "
    + ", ".join(f"CAST('{float(x)!r}' AS DOUBLE) AS \"{c}\"" for c, x in part.items())
    for k, parts in enumerate(mixing.integrated(mixing.SCHEDULES)) for i, part in enumerate(parts)
)
_PLAIN = r"'[^\x20\x09-\x0D]+'"

SQL = {
    "op3_decontamination": f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOWER}, {_LETTERS}) AS w FROM benchmark),
windows AS (
  SELECT item_id, least(10, len(w)) AS size, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS words
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
doc AS (SELECT rowid AS r, doc_id, regexp_extract_all({_LOWER}, {_LETTERS}) AS w
  FROM (SELECT doc_id, text, row_number() OVER () AS rowid FROM documents)),
runs AS (
  SELECT r, i, size, array_to_string(w[i : i + size - 1], ' ') AS words
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, sizes WHERE len(w) >= size)),
met AS (SELECT r, i, runs.size, item_id FROM runs JOIN windows USING (size, words)),
hit AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(i, i + size)) AS place FROM met) GROUP BY r),
named AS (
  SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM met) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
""",
    "op5_mixing": f"""
WITH doc AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), {_PLAIN})) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS held FROM doc GROUP BY source),
numbered AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS place FROM src),
ranked AS (SELECT *, CAST([5, 2, 1][place + 1] AS DOUBLE) AS w FROM numbered),
steps AS (
  SELECT *, sum(held) OVER () AS total,
    coalesce(sum(3 * held) OVER (ORDER BY 3 * held / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
    sum(w) OVER (ORDER BY 3 * held / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
  FROM ranked),
level AS (
  SELECT arg_min((total - full_before) / free, (3 * held / w, source)) AS level FROM steps
  WHERE (total - full_before) / free * w <= 3 * held),
targets AS (SELECT source, held, place, round(least(w * coalesce(level, 0), 3 * held), 6) AS target FROM ranked, level),
placed AS (
  SELECT doc_id, size, held, target, place,
    sum(size) OVER (PARTITION BY doc.source ORDER BY digest, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start
  FROM doc JOIN targets ON doc.source IS NOT DISTINCT FROM targets.source),
passes AS (
  SELECT *, (start + n * held + size / 2) / target AS share
  FROM (SELECT *, unnest([0, 1, 2]) AS n FROM placed) WHERE start + n * held + size / 2 < target),
stretch AS ({_STRETCHES}),
met AS (
  SELECT passes.*, stretch AS s FROM passes JOIN stretch ON schedule = place % {len(mixing.SCHEDULES)} AND ("to" > share OR final)
  QUALIFY row_number() OVER (PARTITION BY doc_id, n ORDER BY i) = 1),
moments AS (
  SELECT *, s.w + sqrt(greatest(s.w * s.w + 2 * s.slope * greatest(share - s.done, 0), 0)) AS root FROM met),
taken AS (
  SELECT doc_id, row_number() OVER (ORDER BY s.t + CASE WHEN root > 0 THEN 2 * greatest(share - s.done, 0) / root ELSE 0 END, doc_id) AS position
  FROM moments)
SELECT doc_id, size, held AS source_size, CAST(target AS DOUBLE) AS target, CAST(size * count(position) AS BIGINT) AS taken,
  min(position) AS first_position
FROM placed LEFT JOIN taken USING (doc_id) GROUP BY doc_id, size, held, target
""",
    "op7_chat": r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *, 19 + length(role || text) + length(regexp_replace(role || ' ' || text, '[^\\]', '', 'g'))
    + len(regexp_extract_all(role || ' ' || text, '<turn>|<says>|</turn>')) AS size FROM rows),
grouped AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    CAST(sum(size) AS BIGINT) AS formatted_chars
  FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars FROM grouped
""",
    "op8_main_text": r"""
WITH parts AS (
  SELECT page_id, url, unnest(regexp_split_to_array(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '</?(?:p|h1)>')) AS part,
    generate_subscripts(regexp_split_to_array(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '</?(?:p|h1)>'), 1) AS i
  FROM pages),
clean AS (
  SELECT page_id, url, i, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    part, '<br>', ' ', 'g'), '<[^>]*>', '', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS part
  FROM parts),
joined AS (
  SELECT page_id, url, coalesce(string_agg(part, chr(10) ORDER BY i) FILTER (part <> ''), '') AS text FROM clean GROUP BY page_id, url)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM joined
""",
    "op9_near_duplicates": f"""
WITH RECURSIVE doc AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_PLAIN}) AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i : i + least(4, len(w)) - 1], ' ')) AS s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM doc WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
least AS (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
  doc_id = least(doc_id, coalesce(low, doc_id)) AS kept
FROM doc LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
""",
    "op11_filter_audit": f"""
WITH doc AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_PLAIN}) AS w
  FROM documents),
flags AS (
  SELECT doc_id, part, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t), regexp_matches(t, '[#$%&*|]'),
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS f FROM doc),
marks AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
profile AS (
  SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM flags LEFT JOIN marks USING (doc_id) GROUP BY part, f),
letter AS (SELECT unnest(range(1, 6)) AS i),
orders AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
first AS (
  SELECT part, o, f, n, good, toxic, coalesce(list_position(list_transform(o, lambda x: f[x]), true), 6) AS gone
  FROM profile, orders),
steps AS (SELECT o, unnest(range(1, 6)) AS step FROM orders),
counted AS (
  SELECT part, o, step, sum(n) FILTER (gone > step) AS kept, sum(n) FILTER (gone = step) AS removed,
    sum(n) FILTER (f[o[step]] AND gone < step) AS redundant,
    sum(n) FILTER (f[o[step]] AND len(list_filter(f, lambda x: x)) = 1) AS unique_fails,
    sum(good) FILTER (gone = step) AS good_lost, sum(toxic) FILTER (gone = step) AS toxic_lost
  FROM first JOIN steps USING (o) GROUP BY part, o, step)
SELECT part, array_to_string(list_transform(o, lambda x: substr('ABCDE', x, 1)), '') AS filter_order, CAST(step AS INT) AS step,
  CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, o[step]) AS BIGINT) AS shapley
FROM counted
""",
    "op12_near_vectors": """
WITH RECURSIVE vec AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vec a JOIN vec b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a AS vec_id, min(b) AS low FROM reach GROUP BY a),
linked AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM embeddings LEFT JOIN linked USING (vec_id) LEFT JOIN least USING (vec_id)
""",
    "op13_hard_negatives": """
WITH vec AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM vec a JOIN vec b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positive AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INT) AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
""",
}
