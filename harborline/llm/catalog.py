"""The queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm import ann, chat, fim, forest, language_id, lattice, minhash, mixing, negatives, packing, sentencepiece, token_files, toxicity
from harborline.llm.common import remainder, stored, table
from harborline.llm.stages import TARGETS
from harborline.settings import work_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(job):
        QUERIES[name] = job
        if sql is not None:
            ORACLES[name] = sql
        return job

    return register


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file lies; only queries that need one need the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


_COMPONENTS = """
reach AS (SELECT a, a AS b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
found AS (SELECT a AS id, min(b) AS component FROM reach GROUP BY a)
"""


@query(
    "op1_nearest_neighbours",
    """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND list_count(embedding) = len(embedding) AND isfinite(list_sum(CAST(embedding AS DOUBLE[]))) AND list_max(embedding) <> list_min(embedding)),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
""",
)
def op1_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest by inner product of every vector whose id is divisible by 20, among all."""
    return ann.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query(
    "op2_embedding_near_duplicates",
    f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND list_count(embedding) = len(embedding) AND isfinite(list_sum(CAST(embedding AS DOUBLE[]))) AND list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0),
links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND p.vec_id <> q.vec_id AND list_cosine_similarity(p.e, q.e) >= 0.98),
{_COMPONENTS},
counted AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id, vec_id = coalesce(component, vec_id) AS kept
FROM embeddings LEFT JOIN found ON vec_id = found.id LEFT JOIN counted ON vec_id = counted.id
""",
)
def op2_embedding_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Links and classes of all vectors of one label with a cosine of 0.98 or more."""
    return forest.near_duplicates(table(spark, folder, "embeddings"), 0.98)


@query("op3_mixing_to_targets")
def op3_mixing_to_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Rates of all documents that give the quality labels their target shares of the tokens."""
    docs = table(spark, folder, "documents")
    mixed = mixing.mix_to_targets(docs, table(spark, folder, "labels"), TARGETS, keep=["doc_id", "source"])
    return mixed.select("row.doc_id", "row.source", "made.tokens", "made.posteriors", "made.rate", "made.copies")


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learned from labels of documents whose crc32 modulo 5 is not 0."""
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs.where(~toxicity.held_out()), table(spark, folder, "labels"))
    found = toxicity.score(docs, model, ["doc_id"])
    return found.select("row.doc_id", (remainder(F.col("row.doc_id"), 5) == 0).alias("held_out"), "made.score", (F.col("made.score") >= 0.5).cast("int").alias("predicted"))


@query(
    "op5_minhash_near_duplicates",
    f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \\t-\\r]+') AS w FROM documents),
flat AS (
  SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM worded WHERE len(w) >= 3)
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM worded WHERE len(w) IN (1, 2)),
sizes AS (SELECT doc_id, count(s) AS n FROM worded LEFT JOIN flat USING (doc_id) GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM flat x JOIN flat y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
{_COMPONENTS}
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, coalesce(component, doc_id) AS component_id, doc_id = coalesce(component, doc_id) AS kept
FROM sizes LEFT JOIN found ON doc_id = id
""",
)
def op5_minhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate classes of all documents: three-word shingles, similarity 0.85."""
    return minhash.near_duplicates(table(spark, folder, "documents"), words=3, percent=85)


@query("op8_language_id")
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from those whose crc32 modulo 4 is not 2."""
    docs = table(spark, folder, "documents")
    model = language_id.fit(docs.where(~language_id.held_out()))
    found = language_id.identify(docs, model, ["doc_id"])
    return found.select("row.doc_id", (remainder(F.col("row.doc_id"), 4) == 2).alias("held_out"), "made.lang_pred", "made.score", "made.coverage")


@query("op6_sentencepiece")
def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of every document and, decoded again, whether the text came back exactly."""
    path = vocabulary("piece_bpe_32k.model")
    made = sentencepiece.encode(table(spark, folder, "documents"), path, ["doc_id", "text"])
    back = sentencepiece.decode(made.select("row.doc_id", "row.text", "made.ids", "made.score"), path, into="decoded")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.crc32(F.array_join("ids", ",").cast("binary")).alias("ids_crc32"), "score", (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("round_trip"))


@query(
    "op7_chat_formatting",
    """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, length(replace(replace(role, '&', '&amp;'), '<', '&lt;')) + length(replace(replace(text, '&', '&amp;'), '<', '&lt;')) + 13 AS size FROM rows),
joined AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss, sum(size) AS formatted_chars
  FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM joined
""",
)
def op7_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one with control strings in its texts, formatted and read back."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    formatted = chat.format_trees(stored(chat.conversation_messages(rows.union(hard)), "messages"))
    back = formatted.withColumn("back", chat.turns_of(F.col("formatted"))).withColumn("learned", chat.learned_text(F.col("formatted"), F.col("loss")))
    turns = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        F.col("tree_id").alias("conv_id"), F.size("back").cast("long").alias("n_turns"), F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op9_token_files")
def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as token files, read back: start, number and checksum of each document's ids."""
    path = work_path(spark, "token-files")
    token_files.write(table(spark, folder, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op10_lattice_scores")
def op10_lattice_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Log10 probabilities of all documents, learned from those whose crc32 modulo 7 is not 2."""
    docs = table(spark, folder, "documents")
    scored = lattice.score(docs, remainder(F.col("doc_id"), 7) != 2, vocabulary("piece_bpe_32k.model"))
    return scored.select("doc_id", (remainder(F.col("doc_id"), 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query(
    "op11_fill_in_middle",
    """
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
units AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u,
    CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM hashed),
cuts AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM units),
parts AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
""",
)
def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """All documents cut by lines into fill-in-the-middle form, and restored from output and form."""
    made = fim.transform(table(spark, folder, "documents"), keep=["doc_id"]).select("row.doc_id", "made.*")
    back = fim.restore(made, F.col("output"), F.col("form"))
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return back.select("row.doc_id", "row.n", "row.form", "row.prefix_chars", "row.middle_chars", digest("row.output").alias("output_sha256"), digest("made.text").alias("restored_sha256"))


@query(
    "op12_hard_negatives",
    """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND list_count(embedding) = len(embedding) AND isfinite(list_sum(CAST(embedding AS DOUBLE[])))),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.q, c.q) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM scored WHERE same) WHERE place <= 5),
negatives AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS rank, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5
""",
)
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """For rows whose id is divisible by 100: five positives, and five negatives of 80 to 100 % of each one's score, among all rows."""
    rows = table(spark, folder, "embeddings")
    noisy = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.mine(noisy, F.col("vec_id") % 100 == 0)


@query("op13_packing")
def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as pieces of sequences of at most 4096 tokens."""
    return packing.pack(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))
