"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from groundshift.llm import ann, chat, imatch, jaccard, licenses, mixing, phrases, pieces, quality, simhash, tokenfile, warc, whiten
from groundshift.llm.scratch import new_folder, shipped

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = shipped(fn)
        if check is not None:
            CHECKS[fn.__name__] = check
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def signed_hex(col: str):
    return F.lower(F.lpad(F.hex(F.col(col)), 16, "0"))


#: The two turns that are added to the table.
EXTRA = r"\### Assistant: </turn> ok"
CHAT_SQL = rf"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '{EXTRA}' union all select -7, 1, 'assistant', '{EXTRA}'),
shown as (
  select *, case role when 'system' then '### System: ' when 'user' then '### User: ' when 'assistant' then '### Assistant: '
                      else '### Role ' || hex(encode(role)) || ': ' end as head,
         regexp_replace(text, '(### (System|User|Assistant|Role [0-9A-F]*): |</turn>)', '\\\1', 'g') as body
  from t)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(length(head) + length(body) + 9)::bigint as formatted_chars
from shown group by conv_id
"""


@query(CHAT_SQL)
def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(EXTRA).alias("text"),
    )
    read = chat.formatted(rows.unionByName(extra)).select(
        "conv_id",
        chat.parse(F.col("formatted")).alias("turns"),
        chat.masked_text(F.col("formatted"), F.col("spans")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query()
def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query()
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(table(spark, sf_dir, "documents"), radius=3, shingle=3)
    return found.select("doc_id", signed_hex("fp").alias("fingerprint"), "component_id")


@query()
def op4_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "ids")
    shards = tokenfile.write(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), end=2)
    return tokenfile.read(spark, shards, folder)


@query()
def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = imatch.compared(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        imatch.as_text(F.col("fingerprint")).alias("fingerprint"),
        imatch.as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@query()
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    rows = quality.score(docs, model, ["doc_id"])
    return rows.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= quality.ACCEPT).cast("int").alias("predicted"),
    )


@query()
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query()
def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pieces.encode(docs, public_tokenizers.path(pieces.MODEL), nbest=3)
    return found.select(
        "doc_id",
        "n_pieces",
        "ids_crc32",
        "score",
        "scores",
        "crcs",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    archives = warc.write(table(spark, sf_dir, "pages"), folder, least_bytes=0)
    return warc.read(spark, archives, folder).drop("url")


#: Word runs, the order of the shuffle, water-filled targets, finish times of all copies, and the cut at the budget.
MIX_SQL = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         md5(concat_ws('|', 'mix', doc_id::varchar, md5(coalesce(text, '')))) as k
  from documents),
per as (select source, sum(size)::bigint as source_size from sized group by source),
ranked as (
  select *, ((row_number() over (order by source nulls last) - 1) % 3 + 1)::double as weight, 3.0::double * source_size as cap from per),
levels as (
  select *, ((sum(source_size) over ())::double - coalesce(sum(cap) over w, 0.0))
            / (sum(weight) over () - coalesce(sum(weight) over w, 0.0)) as lv
  from ranked window w as (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding)),
targets as (
  select source, source_size, least(max(lv) over () * weight, cap) as target from levels),
runs as (
  select s.*, t.source_size, t.target,
         sum(size) over (partition by s.source order by k, size rows between unbounded preceding and current row) as run,
         row_number() over () as id
  from sized s join targets t on s.source is not distinct from t.source),
copies as (
  select *, (source_size * e + run) / target as finish
  from runs, (values (0), (1), (2)) epochs(e)
  where size > 0 and source_size * e + run - size < target),
spent as (
  select id, sum(size) over (order by finish, source nulls first, k, size rows between unbounded preceding and current row) as spent
  from copies),
taken as (select id, count(*) as n from spent where spent <= (select sum(target) from targets) group by id)
select doc_id, size, source_size::bigint as source_size, target, (size * coalesce(n, 0))::bigint as taken
from runs left join taken using (id)
"""


@query(MIX_SQL)
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sizes(table(spark, sf_dir, "documents"), weights=(1, 2, 3), budget_share=1.0, epochs=3)
    return mix.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


#: Pieces and words, counts of all runs of one to four words, lowest-scoring cuts, phrases that longer ones contain.
PHRASE_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
totals as (select lang, sum(len(w))::bigint as n from words group by lang),
runs as (
  select lang, k, array_to_string(w[i : i + k - 1], ' ') as phrase
  from (select lang, w, k, unnest(generate_series(1, len(w) - k + 1)) as i from words, (values (1), (2), (3), (4)) ks(k) where len(w) >= k)),
grams as (select lang, k as words, phrase, count(*) as f from runs group by all having count(*) >= 30),
cuts as (
  select g.lang, g.phrase, g.words, g.f as a, unnest(generate_series(1, g.words - 1)) as k, string_split(g.phrase, ' ') as w
  from grams g where g.words > 1),
valued as (
  select c.*, l.f as l, r.f as r, ((2000000::hugeint * c.a) // (l.f + r.f))::bigint as score
  from cuts c
  join grams l on l.lang = c.lang and l.phrase = array_to_string(c.w[1 : c.k], ' ')
  join grams r on r.lang = c.lang and r.phrase = array_to_string(c.w[c.k + 1 : c.words], ' ')),
best as (select * from valued qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inside as (
  select lang, array_to_string(w[pos : pos + size - 1], ' ') as phrase, max(a) as most
  from (select *, unnest(generate_series(1, words - size + 1)) as pos
        from (select *, unnest(generate_series(2, words - 1)) as size from best where words > 2))
  group by all),
kept as (
  select b.* from best b left join inside i on i.lang = b.lang and i.phrase = b.phrase
  where i.most is null or 100 * i.most < 80 * b.a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""


@query(PHRASE_SQL)
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), least=30, share=80, top=2000)


#: Word runs, distinct five-word shingles, links by shared shingles, and what links reach.
JACCARD_SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
sets as (
  select distinct doc_id, md5(array_to_string(w[i : i + 4], ' ')) as s
  from (select doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) as i from words where len(w) > 0)),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
shared as (
  select a.doc_id as x, b.doc_id as y, count(*) as n from sets a join sets b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (
  select x, y from shared s join sizes a on a.doc_id = s.x join sizes b on b.doc_id = s.y where 100 * s.n >= 80 * (a.n + b.n - s.n)),
both_ways as (select x, y from links union select y, x from links),
reach as (
  select doc_id as x, doc_id as y from words
  union
  select r.x, l.y from reach r join both_ways l on r.y = l.x)
select r.x as doc_id, coalesce(any_value(s.n), 0)::bigint as n_shingles, min(r.y) as component_id
from reach r left join sizes s on s.doc_id = r.x group by r.x
"""


@query(JACCARD_SQL)
def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"), least=80, shingle=5)


@query()
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whitened(table(spark, sf_dir, "embeddings"), scale=256.0, components=4)
