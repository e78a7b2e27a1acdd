"""The queries of this package, each with the SQL of its result where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.llm.align import align
from rosterflow.llm.dedup import exact_dedup
from rosterflow.llm.jaccard import near_duplicates
from rosterflow.llm.language import fit, identify
from rosterflow.llm.licences import scan_licences
from rosterflow.llm.neighbours import nearest
from rosterflow.llm.packing import pack
from rosterflow.llm.pieces import decode_pieces, encode_pieces
from rosterflow.llm.quotes import reply_ordered
from rosterflow.llm.repair import repair, summaries
from rosterflow.llm.secrets import secret_spans
from rosterflow.llm.simhash import hex_digits, near_copies
from rosterflow.llm.warc import RECORD_ID, classify, new_folder, read_archives, write_archives
from rosterflow.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op2_sentencepiece(spark, sf_dir):
    path = tokenizer_file("piece_bpe_32k.model")
    encoded = encode_pieces(table(spark, sf_dir, "documents"), path)
    return decode_pieces(encoded, path).select(
        F.col("key").alias("doc_id"),
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def counted(kind):
    return F.size(F.filter("secrets", lambda s: s.kind == kind)).cast("bigint").alias(f"n_{kind}")


@query()
def op3_secrets(spark, sf_dir):
    base = F.filter("secrets", lambda s: s.kind != "entropy")
    return secret_spans(table(spark, sf_dir, "documents")).select(
        F.col("key").alias("doc_id"), counted("assign"), counted("access"), counted("hex"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"), counted("entropy"),
    )


@query()
def op4_packing(spark, sf_dir):
    pieces = pack(
        table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("byte_bpe_50k.tiktoken"),
        keep_ids=False,
    )
    return pieces.withColumnRenamed("key", "doc_id")


@query()
def op7_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = fit(docs.where(~held_out))
    found = identify(docs, model)
    return found.select(
        F.col("key").alias("doc_id"), (F.crc32(F.col("key").cast("string")) % 4 == 2).alias("held_out"), "lang_pred", "score"
    )


_COPIES = """WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)"""


@query(_COPIES)
def op9_exact_dedup(spark, sf_dir):
    found = exact_dedup(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("key").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


@query(
    """WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
q AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest,
    min(page_id) OVER (PARTITION BY sha256(payload)) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to FROM q"""
)
def op6_warc(spark, sf_dir):
    """The digest and size of responses are those of the payload read back, of revisits those of their heads."""
    folder = new_folder(shared_dir(spark))
    archives = write_archives(classify(table(spark, sf_dir, "pages")), folder)
    read = read_archives(spark, archives, range_bytes=4 << 20)
    number = lambda c: F.expr(f"try_cast(substring({c}, {len(RECORD_ID) + 1}) AS bigint)")
    return read.select(
        number("record_id").alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("bigint"), "payload_bytes").alias("payload_bytes"),
        F.coalesce(F.sha2("payload", 256), "payload_digest").alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )


@query()
def op5_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0))


_MAIL = """WITH m AS (SELECT conv_id, turn, role, regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g') AS text FROM conversations),
p AS (SELECT m.*, q.turn AS parent_turn, coalesce(len(list_filter(string_split(q.text, chr(10)), lambda x: trim(x) <> '')), 0) AS one,
    coalesce(len(list_filter(string_split(r.text, chr(10)), lambda x: trim(x) <> '')), 0) AS two
  FROM m LEFT JOIN m q ON q.conv_id = m.conv_id AND q.turn = m.turn - 1 AND q.text <> ''
    LEFT JOIN m r ON r.conv_id = m.conv_id AND r.turn = m.turn - 2 AND r.text <> ''),
t AS (SELECT *, max(CASE WHEN parent_turn IS NULL THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS root_turn FROM p)
SELECT conv_id, turn, role, text, parent_turn, root_turn, turn - root_turn AS depth,
  row_number() OVER (PARTITION BY conv_id ORDER BY root_turn, turn) - 1 AS position, CAST(one + two AS BIGINT) AS quoted,
  CAST(one + two AS BIGINT) AS linked, concat('<|', coalesce(role, 'unknown'), '|>', chr(10), text) AS formatted FROM t"""


def mails(conversations: DataFrame) -> DataFrame:
    """Conversations as mail: each turn over quotes of the two turns before it, the older one a level deeper."""
    before = lambda n: conversations.select(
        "conv_id", (F.col("turn") + n).alias("turn"), F.regexp_replace("text", "(?m)^", "> " * n).alias(f"quote{n}")
    )
    own = F.coalesce("text", F.lit(""))
    joined = conversations.join(before(1), ["conv_id", "turn"], "left").join(before(2), ["conv_id", "turn"], "left")
    announced = F.when(F.col("quote1").isNotNull(), F.concat(F.lit("On Monday someone wrote:\n"), F.concat_ws("\n", "quote2", "quote1"), F.lit("\n\n")))
    return joined.select("conv_id", "turn", "role", F.concat(F.coalesce(announced, F.lit("")), own).alias("text"))


@query(_MAIL)
def op1_quotes(spark, sf_dir):
    """What went into the mails comes out: the texts, the message before each as its parent, the order."""
    return reply_ordered(mails(table(spark, sf_dir, "conversations")))


def as_files(documents: DataFrame) -> DataFrame:
    """Documents laid out as a tree of files; every fifth is a licence file of its upper directory."""
    return documents.select(
        "doc_id", "text",
        F.expr(
            "concat(source, '/p', CAST(doc_id DIV 10 % 20 AS STRING), CASE WHEN doc_id % 5 = 0 "
            "THEN concat('/LICENSE.', CAST(doc_id AS STRING)) ELSE concat('/s', CAST(doc_id % 4 AS STRING), '/', CAST(doc_id AS STRING), '.txt') END)"
        ).alias("path"),
    )


@query()
def op10_licences(spark, sf_dir):
    found = scan_licences(as_files(table(spark, sf_dir, "documents")))
    return found.withColumnRenamed("key", "doc_id")


@query()
def op8_jaccard_join(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("cls").alias("class_id"))


@query()
def op13_simhash(spark, sf_dir):
    found = near_copies(table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id", "n_shingles")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, broken off, repeated or given to the user, by the checksum of their place."""
    place = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(place) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    copies = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return conversations.where(kind != 0).select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


@query()
def op12_repair(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations")
    found = summaries(repair(damaged(conversations)))
    every = conversations.select("conv_id").distinct()
    joined = every.join(found, every.conv_id.eqNullSafe(found.conv), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@query()
def op11_align(spark, sf_dir):
    files = (tokenizer_file(f) for f in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"))
    return align(table(spark, sf_dir, "documents"), *files).withColumnRenamed("key", "doc_id")
