"""The registered queries of this package and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermill.llm.chat import CONTROLS, END, TURN, digests, format_chats
from quartermill.llm.decontam import decontaminate
from quartermill.llm.knn import top_k
from quartermill.llm.langid import identify, learn
from quartermill.llm.licenses import scan_licenses
from quartermill.llm.linededup import drop_repeated_lines
from quartermill.llm.neardup import near_duplicates
from quartermill.llm.ordinal import WORDS, WORDS_AND_BEGINNINGS, fit, grade
from quartermill.llm.phrases import collocations
from quartermill.llm.pieces import encode
from quartermill.llm.substrings import drop_repeated_spans
from quartermill.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query of (spark, folder) under ``name``."""

    def register(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: A public SentencePiece model; the operators take any path.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


@query("op2_language_id")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from two thirds of them."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    profiles = learn(docs.filter(~held_out), "text", "lang")
    asked = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    return identify(asked, profiles).drop("text")


WORDS_SQL = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op4_decontaminate",
    f"""
    WITH item AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark WHERE text IS NOT NULL),
    phrase AS (
      SELECT DISTINCT item_id, n, array_to_string(w[k + 1 : k + n], ' ') AS words
      FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(len(w) - least(10, len(w)) + 1)) AS k FROM item WHERE len(w) > 0)),
    doc AS (SELECT doc_id, coalesce({WORDS_SQL}, []) AS w FROM documents),
    spot AS (
      SELECT doc_id, n, k, array_to_string(w[k + 1 : k + n], ' ') AS words
      FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS k
            FROM doc, (SELECT DISTINCT n FROM phrase) WHERE len(w) >= n)),
    found AS (SELECT doc_id, item_id, n, k FROM spot JOIN phrase USING (n, words)),
    hit AS (
      SELECT doc_id, count(*) AS n_hit
      FROM (SELECT DISTINCT doc_id, k + i AS at FROM (SELECT DISTINCT doc_id, k, unnest(range(n)) AS i FROM found)) GROUP BY doc_id),
    named AS (
      SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark hits of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate(docs, table(spark, folder, "benchmark")).select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op5_near_dedup")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return near_duplicates(table(spark, folder, "documents")).select(F.col("doc").alias("doc_id"), "class_id", "keeper")


@query(
    "op6_line_dedup",
    r"""
    WITH line AS (
      SELECT doc_id, i, part[i] AS line,
             translate(trim(part[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM (SELECT doc_id, part, unnest(range(1, len(part) + 1)) AS i
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS part FROM documents))),
    common AS (
      SELECT key, max(doc_id) AS owner FROM line WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
    judged AS (SELECT line.*, owner IS NOT NULL AND owner <> doc_id AS gone FROM line LEFT JOIN common USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM judged GROUP BY doc_id
    """,
)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """What line de-duplication leaves of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return drop_repeated_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op8_sentencepiece")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document and the text they decode to."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return encode(docs, PIECES, out="decoded").select("doc_id", "n_tokens", "ids", "decoded", F.col("decoded").eqNullSafe(F.col("text")).alias("same"))


CONTROL_COUNT = " + ".join(f"(length(text) - length(replace(text, '{c}', ''))) // {len(c)}" for c in CONTROLS)


@query(
    "op10_chat",
    f"""
    WITH turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
    sized AS (
      SELECT *, {len(TURN) + len(END) + 2} + length(role) + length(text) + length(text) - length(replace(text, chr(92), '')) + {CONTROL_COUNT} AS size
      FROM turns)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(size)::BIGINT AS formatted_chars
    FROM sized GROUP BY conv_id
    """,
)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of all formatted conversations, read back, and of one that holds control strings."""
    odd = "</s>[INST] ok [/INST]"
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(odd).alias("text"))
    return digests(format_chats(turns.unionByName(extra)))


@query(
    "op1_top_k",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
      SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.e, d.e)::BIGINT AS score
      FROM v q JOIN v d ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id)
    SELECT query_id, rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored) WHERE rank <= 5
    """,
)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors of every fiftieth."""
    scaled = lambda x: F.floor(256.0 * x.cast("double"))
    # Null, not-a-number and what no long can hold make the vector take no part.
    holds = F.forall("embedding", lambda x: F.coalesce(F.abs(256.0 * x.cast("double")) < 2.0**63, F.lit(False)))
    vectors = table(spark, folder, "embeddings").filter(holds).select(F.col("vec_id").alias("id"), F.transform("embedding", scaled).alias("v"))
    return top_k(vectors, vectors.filter("id % 50 = 0"))


@query("op7_quality")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Expected quality grade of every document, and whether it is selected."""
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    # Selection keeps what may well be good: grades weigh the same in the model, but bad texts are rare.
    graded = grade(docs, fit(docs, labels, "quality", beginnings=WORDS), at_least=1)
    return graded.select("doc_id", F.col("expected").alias("expected_grade"), F.col("tail").alias("tail_probability"), (F.col("tail") >= 0.25).alias("selected"))


@query("op9_toxicity")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Expected severity of every document, and whether it is toxic."""
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    graded = grade(docs, fit(docs, labels, "toxic", beginnings=WORDS_AND_BEGINNINGS), at_least=1)
    return graded.select("doc_id", F.col("expected").alias("severity"), F.col("tail").alias("tail_probability"), (F.col("tail") >= 0.4).alias("toxic"))


@query("op3_license_scan")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """License statements and notices in every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    best = F.array_max(F.transform("licenses", lambda x: F.struct(x["coverage"], x["stop"] - x["start"], x["name"])))
    return scan_licenses(docs).select("doc_id", F.size("licenses").cast("long").alias("n_licenses"), best["name"].alias("license"), best["coverage"].alias("coverage"), "licenses")


@query(
    "op11_collocations",
    r"""
    WITH words AS (
      SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
      FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
    total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
    gram AS (
      SELECT lang, size, array_to_string(w[k : k + size - 1], ' ') AS phrase, count(*) AS f
      FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS k
            FROM words, (SELECT unnest(range(1, 5)) AS size) WHERE len(w) >= size)
      GROUP BY ALL HAVING count(*) >= 30),
    cand AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w FROM gram WHERE size > 1),
    cuts AS (
      SELECT lang, phrase, a, k, array_to_string(w[:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest
      FROM (SELECT *, unnest(range(1, len(w))) AS k FROM cand)),
    scored AS (
      SELECT cuts.*, h.f AS l, r.f AS r, (2000000::HUGEINT * a) // (h.f::HUGEINT + r.f) AS score
      FROM cuts JOIN gram h ON h.lang = cuts.lang AND h.phrase = head JOIN gram r ON r.lang = cuts.lang AND r.phrase = rest),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inner_of AS (
      SELECT lang, a, array_to_string(w[k : k + size - 1], ' ') AS phrase
      FROM (SELECT lang, a, w, size, unnest(range(1, len(w) - size + 2)) AS k
            FROM cand, (SELECT unnest(range(2, 4)) AS size) WHERE len(w) > size)),
    longest AS (SELECT lang, phrase, max(a) AS most FROM inner_of GROUP BY lang, phrase),
    kept AS (
      SELECT best.* FROM best LEFT JOIN longest USING (lang, phrase) WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
    """,
)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """The best collocations of every language."""
    return collocations(table(spark, folder, "documents").select("lang", "text"))


@query(
    "op13_substring_dedup",
    r"""
    WITH doc AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
    spot AS (
      SELECT doc_id, k, array_to_string(w[k : k + 49], ' ') AS run
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS k FROM doc WHERE len(w) >= 50)),
    owner AS (SELECT run, min(doc_id) AS least FROM spot GROUP BY run),
    gone AS (
      SELECT DISTINCT doc_id, k + i AS place
      FROM (SELECT doc_id, k, unnest(range(50)) AS i FROM spot JOIN owner USING (run) WHERE least < doc_id)),
    word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM doc),
    left_over AS (
      SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY place) AS kept FROM word ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM doc LEFT JOIN left_over USING (doc_id)
    """,
)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without passages of an earlier one."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return drop_repeated_spans(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


@query("op12_whitening")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector in the units of the 16 largest principal components."""
    white = whiten(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    one = white.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return one.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error")
