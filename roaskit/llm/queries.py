"""Queries of the training-data operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roaskit.llm import bpe, chat, exact_dedup, html_extract, jaccard, langid, lexical, lm, minhash, packing, repair, token_shards, topk
from roaskit.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@register("op2_exact_top_k", """
with v as (
    select vec_id, [floor(256 * x::double) for x in embedding] as x
    from embeddings
    where vec_id is not null and embedding is not null
      and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (
    select q.vec_id as query_id, c.vec_id, list_inner_product(q.x, c.x)::bigint as score
    from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id and len(q.x) = len(c.x)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_inner_products(table(spark, sf_dir, "embeddings"))


@register("op3_html_extraction")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


@register("op4_lm_scoring")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


@register("op5_exact_dedup", """
with t as (select doc_id, coalesce(text, '') as text from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id = max(doc_id) over w as kept, sha256(text) as text_sha256
from t window w as (partition by text)""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_copies(table(spark, sf_dir, "documents"))


#: The pattern of ``chat.escape`` once more, for DuckDB.
_ESCAPED = r"([<\[])(\\*)(" + chat.CONTROL + ")"


@register("op6_chat_formatting", rf"""
with c as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e as (
    select *, length(regexp_replace(role, '{_ESCAPED}', '\1\\\2\3', 'g')) +
              length(regexp_replace(text, '{_ESCAPED}', '\1\\\2\3', 'g')) + {len(chat.TURN + chat.TEXT + chat.END)} as chars
    from c),
g as (
    select conv_id, count(*) as n_turns,
           string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) as turns,
           coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '') as loss,
           sum(chars)::bigint as formatted_chars
    from e group by conv_id)
select conv_id, n_turns, sha256(turns) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256,
       formatted_chars
from g""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql("""select -7L conv_id, t.turn, t.role, '</s>[INST] ok [/INST]' text
                         from values (0L, 'user'), (1L, 'assistant') as t(turn, role)""")
    return chat.digests(chat.format_conversations(rows.unionByName(probe)))


@register("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict_language(docs, langid.fit(docs))


#: The end-of-text id of ``word_bpe_49k.json``, which no text is encoded to, and the number of its ids.
WORD_END_ID, WORD_IDS = 49407, 49408


@register("op8_token_shards")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.write_shards(table(spark, sf_dir, "documents"), tokenizer_path=public_tokenizers.path("word_bpe_49k.json"),
                                     end_id=WORD_END_ID, vocabulary=WORD_IDS).read()


@register("op9_ngram_jaccard")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=85)


@register("op10_byte_bpe")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          public_tokenizers.PATTERN)


@register("op11_lexical_search", r"""
with d as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
    from documents),
k as (select count(*)::bigint as docs, sum(len(terms))::bigint as total from d where len(terms) > 0),
tf as (select doc_id, len(terms)::bigint as n, unnest(terms) as term from d),
f as (select doc_id, n, term, count(*)::bigint as tf from tf group by all),
w as (
    select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
    from f, k group by term, docs),
i as (
    select distinct item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark),
s as (
    select item_id, doc_id,
           sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))))::bigint as score
    from i join f using (term) join w using (term), k group by item_id, doc_id),
r as (select *, row_number() over (partition by item_id order by score desc, doc_id)::integer as rank from s where score > 0)
select item_id, rank, doc_id, score from r where rank <= 50""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


@register("op12_minhash_dedup")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=5, percent=85)


def _repair_sql() -> str:
    """Damage, faults, and the cheapest edits row by row: the best (cost, audit) of each state of the pattern."""
    def plus(cell: str, cost: str, edit: str) -> str:
        return f"{{'c': {cell}.c + {cost}, 'a': {cell}.a || '{edit}'}}"

    def least(*cells: str) -> str:
        return f"list_min([{', '.join(cells)}])"

    crc = ("list_reduce([4294967295::bigint] || list_transform(string_split(key, ''), lambda x: ord(x)::bigint), lambda c, b: "
           "list_reduce([xor(c, b)] || range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))")
    closed = (f"r0 as c0, r1 as c1, {least('r2', plus('r0', '2', 'I'), plus('r1', '2', 'I'), plus('r3', '2', 'I'))} as c2, "
              f"{least('r3', plus('r2', '2', 'I'), plus('r0', '4', 'II'), plus('r1', '4', 'II'))} as c3")
    to_u, kept, given = least("c0", "c1", "c3"), "case when not gone and initial = '{}' then cut else 1000000 end", "case when gone then 1000000 else 2 + cut end"
    raw = (f"{plus('c0', '3', 'D')} as r0, {least(plus('c1', '3', 'D'), plus('c0', kept.format('s'), 'K'))} as r1, "
           f"{least(plus('c2', '3', 'D'), plus(to_u, kept.format('u'), 'K'), plus(to_u, given, 'R'))} as r2, "
           f"{least(plus('c3', '3', 'D'), plus('c2', kept.format('a'), 'K'), plus('c2', given, 'R'))} as r3")
    return rf"""
with recursive
h as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
           coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key from conversations),
k as (select *, xor({crc}, 4294967295) % 20 as harm from h),
d as (
    select conv_id, turn, case when harm = 4 then 'user' else role end as role,
           case harm when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
           unnest(range(case when harm = 3 then 2 else 1 end)) as copy
    from k where harm <> 0),
p as (select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as pos from d),
f as (
    select *, not regexp_matches(text, '[^ 	-]') as blank,
           row_number() over (partition by conv_id, role, text order by pos) > 1 as again,
           not regexp_matches(text, '[.!?][ 	-]*\z') as open,
           left(role, 1) as initial, lag(left(role, 1)) over (partition by conv_id order by pos) as before from p),
r as (select *, blank or again as gone, case when open and not blank and not again then 1 else 0 end as cut from f),
dp as (
    select conv_id, 0::bigint as pos, {closed}
    from (select distinct conv_id, {{'c': 0::bigint, 'a': ''}} as r0, {{'c': 1000000::bigint, 'a': ''}} as r1,
                 {{'c': 1000000::bigint, 'a': ''}} as r2, {{'c': 1000000::bigint, 'a': ''}} as r3 from conversations)
    union all
    select conv_id, pos, {closed}
    from (select r.conv_id, r.pos, {raw} from dp join r on r.conv_id is not distinct from dp.conv_id and r.pos = dp.pos + 1)),
n as (
    select conv_id, count(*) as rows, max(turn) - min(turn) + 1 - count(distinct turn) as gaps,
           count(*) filter (blank) as blank, count(*) filter (again and not blank) as duplicate,
           count(*) filter (cut = 1) as truncated,
           count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
    from r group by conv_id),
b as (
    select dp.conv_id, least(c0, c3) as best, n.* exclude (conv_id)
    from dp left join n on n.conv_id is not distinct from dp.conv_id where dp.pos = coalesce(n.rows, 0)),
e as (
    select conv_id, i, best.a[i] as edit, length(replace(left(best.a, i), 'I', '')) as pos
    from (select conv_id, best, unnest(range(1, length(best.a) + 1)) as i from b)),
l as (
    select e.conv_id, e.i, e.edit, r.role, r.text, r.initial, row_number() over w as j,
           (first_value(r.initial) over w = 's' and first_value(e.edit) over w = 'K')::int as led
    from e left join r on r.conv_id is not distinct from e.conv_id and r.pos = e.pos and e.edit <> 'I'
    where e.edit <> 'D' window w as (partition by e.conv_id order by e.i)),
t as (
    select conv_id, string_agg(case when edit = 'K' then role else case when (j - coalesce(led, 0)) % 2 = 1 then 'user' else 'assistant' end end
                               || ':' || case when edit = 'I' then '' else text end, chr(10) order by i) as repaired
    from l group by conv_id)
select b.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, best.c as cost, best.a as audit,
       sha256(coalesce(repaired, '')) as repaired_sha256
from b left join t on t.conv_id is not distinct from b.conv_id"""


@register("op13_structure_repair", _repair_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_conversations(table(spark, sf_dir, "conversations"))
