"""The registered queries of the operators, with SQL where SQL can say the same."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.llm import bpe, chat, cross_entropy, decontaminate, divergence, infill, language, lines, nearest, quality, sharding, simhash, warc
from shelfmatch.llm.common import bound_batches, table
from shelfmatch.sources.staging import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql.strip()
        return function

    return add


def vocabulary() -> str:
    """The text of the vocabulary file, read by the driver; tasks get it with the function they run."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


def remainder(n: int):
    """crc32 of the ``doc_id`` as text, modulo ``n``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def language_model(docs: DataFrame) -> language.Model:
    return language.learn(docs.where(remainder(5) != 0))


@query()
def op1_ann_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest of every row whose ``vec_id`` is divisible by 20, among all rows."""
    return nearest.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query()
def op2_cross_entropy_difference(spark: SparkSession, folder: str) -> DataFrame:
    """Target: the documents labelled as good."""
    bound_batches(spark, 8, 10_000)  # the words of 8 MB of text are counted together
    good = table(spark, folder, "labels").where("quality = 1").select("doc_id")
    return cross_entropy.score_documents(table(spark, folder, "documents"), good)


@query()
def op3_shard_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Eight shards of near equal bytes."""
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    found = sharding.shard_documents(table(spark, folder, "documents").withColumn("text_crc32", crc))  # no text is dealt
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("""
with lines as (
  select doc_id, generate_subscripts(parts, 1) as pos, unnest(parts) as line
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents)),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as line_key
  from lines),
repeated as (
  select line_key, min(doc_id) as first from keyed where length(line_key) >= 10 group by line_key having count(distinct doc_id) >= 2),
marked as (
  select k.doc_id, k.pos, k.line, r.first is not null and r.first <> k.doc_id as gone
  from keyed k left join repeated r on k.line_key = r.line_key)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from marked group by doc_id
""")
def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.drop_repeated_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query()
def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = language.identify(docs, language_model(docs))
    return found.select("doc_id", (remainder(5) == 0).alias("held_out"), "lang_pred", "score")


@query()
def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    source = vocabulary()
    found = bpe.decode(bpe.encode(table(spark, folder, "documents").select("doc_id", "text"), source), source)
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query()
def op7_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@query()
def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").where(remainder(3) != 1)
    found = quality.score_quality(table(spark, folder, "documents"), labels)
    return found.select("doc_id", (remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query()
def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document and benchmark item that it holds."""
    return decontaminate.find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "archives")
    warc.write_archives(table(spark, folder, "pages"), path)
    found = warc.read_archives(spark, path)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem")


@query("""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls last, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls last, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length('<|im_start|>') + length(replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<|', '<||')) + 1
    + length(replace(text, '<|', '<||')) + length('<|im_end|>') + 1) as bigint) as formatted_chars
from turns group by conv_id
""")
def op11_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one whose texts hold controls; the digests are of what is read back from the output."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    found = chat.format_conversations(rows.unionByName(more))
    read = found.select("conv_id", chat.formatted_text(F.col("segments")).alias("formatted"), chat.learned_text(F.col("segments")).alias("learned"))
    read = read.withColumn("turns", chat.read_turns(F.col("formatted")))
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(listed, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


@query("""
with docs as (
  select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
found as (select id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs),
kept as (select lang, term, count(*) as n_lang from found group by lang, term having count(distinct id) >= 30),
own as (select f.lang, f.source, f.term, count(*) as n from found f join kept k on f.lang = k.lang and f.term = k.term group by all),
sizes as (select lang, count(*) as terms, sum(n_lang) as size_lang from kept group by lang),
own_sizes as (select lang, source, sum(n) as size from own group by lang, source),
groups as (
  select g.lang, g.source, coalesce(o.size, 0) as size, coalesce(s.terms, 0) as terms, coalesce(s.size_lang, 0) as size_lang
  from (select distinct lang, source from docs) g left join own_sizes o on g.lang = o.lang and g.source = o.source left join sizes s on g.lang = s.lang),
shares as (
  select g.lang, g.source, k.term, coalesce(o.n, 0) as n,
    1 + 1000000000::hugeint * (coalesce(o.n, 0) + 5) // (g.size + 5 * g.terms) as p,
    1 + 1000000000::hugeint * (k.n_lang + 5) // (g.size_lang + 5 * g.terms) as q
  from groups g join kept k on g.lang = k.lang left join own o on o.lang = g.lang and o.source = g.source and o.term = k.term),
parts as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(d.value, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join (select x.lang, x.source as sa, y.source as sb, sum(abs(x.p - y.p)) as value from shares x join shares y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by all) d
    on d.lang = a.lang and d.sa = a.source and d.sb = b.source
  union all
  select lang, source, 'term', term, p - q from shares where n > 0 and p > q)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
from (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from parts)
where part = 'pair' or rank <= 50
""")
def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit_sources(table(spark, folder, "documents"))


@query("""
with units as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as units,
    sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
drawn as (
  select *, len(units) as n, ('0x' || h[1:8])::ubigint as h1, ('0x' || h[9:16])::ubigint as h2, ('0x' || h[17:24])::ubigint as h3, ('0x' || h[25:32])::ubigint as h4
  from units),
cut as (
  select *, least(h1 % (n + 1), h2 % (n + 1))::bigint as a, greatest(h1 % (n + 1), h2 % (n + 1))::bigint as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
      when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from drawn),
pieces as (
  select *, array_to_string(units[1:a], '') as prefix, array_to_string(units[a + 1:b], '') as middle, array_to_string(units[b + 1:], '') as suffix from cut)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(prefix) end as prefix_chars, case when form <> 'plain' then length(middle) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from pieces
""")
def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """The restored texts come from the outputs and forms."""
    cut = infill.rearrange(table(spark, folder, "documents").select("doc_id", "text"))
    found = infill.restore(cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "output"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
