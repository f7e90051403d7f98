"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import alignment, archives, automaton, language, mixing, quality, quotes, sharding, simhash, substrings, tiling, token_files, whitening
from tidemark.llm.common import stored, table
from tidemark.llm.files import files_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


ORACLES["op1_substring_dedup"] = r"""
with texts as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
windows as (
  select doc_id, i, words[i:i + 12] as gram from texts, unnest(range(1, len(words) - 11)) t(i) where len(words) >= 13),
firsts as (select gram, min(doc_id) as first_id from windows group by 1),
gone as (
  select distinct doc_id, i + k as place from windows join firsts using (gram), unnest(range(0, 13)) r(k) where first_id < doc_id),
placed as (select doc_id, i as place, words[i] as word from texts, unnest(range(1, len(words) + 1)) t(i)),
marked as (
  select doc_id, place, word, g.place is not null as is_gone from placed left join gone g using (doc_id, place)),
runs as (
  select *, is_gone and not coalesce(lag(is_gone) over (partition by doc_id order by place), false) as begins from marked),
counted as (
  select doc_id, count(*) as n_words, count(*) filter (where is_gone) as n_removed,
    string_agg(word, ' ' order by place) filter (where not is_gone) as kept, count(*) filter (where begins) as n_intervals
  from runs group by 1)
select doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256,
  coalesce(n_intervals, 0) as n_intervals
from documents left join counted using (doc_id)"""


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 13-word windows of documents with smaller ids."""
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"),
                        F.size("removed").cast("long").alias("n_intervals"))


@query
def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, and its source's size and target."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs, keep=stored)
    rows = mixing.taken(docs, mixed).select(
        "doc_id", mixing.n_words(F.col("text")).alias("size"), "times", F.to_json(F.array("source")).alias("pattern"))
    return rows.join(F.broadcast(mixed.patterns.select("pattern", "source_size", "target")), "pattern").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


@query
def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of forty with near equal bytes."""
    found = sharding.shards_of(table(spark, sf_dir, "documents"), 40, keep=stored)
    return found.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


@query
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.learn(docs, ~held_out()))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and likelihood ratio of every document, and the verdict."""
    found = quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=stored)
    return found.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept", "score")


# A digest of 160 bits: five hexadecimal digits are four letters of base 32.
ORACLES["op7_arc_to_warc"] = """
with payloads as (select page_id, coalesce(html, '') as payload from pages),
hashed as (
  select page_id, octet_length(encode(payload)) as payload_bytes, sha1(payload) as hex,
    min(page_id) over (partition by payload) as first_id from payloads)
select page_id, payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    cast(((cast('0x' || substr(hex, cast(i // 4 * 5 + 1 as int), 5) as bigint) >> cast(15 - i % 4 * 5 as bigint)) & 31) + 1 as int), 1)),
    'string_agg', '') as payload_digest,
  case when page_id = first_id then 'response' else 'revisit' end as record_type,
  case when page_id <> first_id then first_id end as refers_to, true as sound
from hashed"""


@query
def op7_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, read back from the WARC files that its ARC record was converted to."""
    return archives.archived(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "sound")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_places(docs: DataFrame) -> DataFrame:
    """Write the token files of some documents and find every document in them."""
    spark = docs.sparkSession
    folder = files_folder(spark, "tokens")
    files = token_files.write_token_files(docs, folder, tokenizer_file())
    # One row a file: the ids of all files before it.
    earlier = Window.orderBy("name").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("name", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)).alias("before"))
    found = token_files.read_token_files(spark, folder).select(
        "name", F.col("id").alias("doc_id"), "first", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))
    return found.join(files, "name").select(
        "doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document, read back from the token files."""
    return token_places(table(spark, sf_dir, "documents"))


@query
def op9_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as mails that quote each other (the table itself has no quotes), linked and unquoted again."""
    mails = quotes.as_mails(table(spark, sf_dir, "conversations"))
    found = quotes.conversations(mails)
    return found.select(F.col("conv").alias("conv_id"), "turn", "role", "text", "reply_to", "thread", "depth", "position",
                        F.coalesce(F.size("quoted"), F.lit(0)).cast("long").alias("n_quoted"))


@query
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the tiles that cover it."""
    found = tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


@query
def op11_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the automaton, and the text that they spell again."""
    rows = automaton.decoded(automaton.encoded(table(spark, sf_dir, "documents"), tokenizer_file()), tokenizer_file())
    return rows.select(F.col("id").alias("doc_id"), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding projected on the first four whitened components of all distinct ones."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"), keep=stored).withColumnRenamed("id", "vec_id")


@query
def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of the tokens of two vocabularies in every document, scored by counts over all of them."""
    found, _ = alignment.aligned(table(spark, sf_dir, "documents"), tokenizer_file(), tokenizer_file("piece_bpe_32k.model"), keep=stored)
    return found.withColumnsRenamed({"id": "doc_id", "digest": "groups_sha256"})
