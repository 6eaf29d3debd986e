"""The operators applied to whole tables: name -> f(spark, folder) -> DataFrame, and SQL where it can say the same."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from clinflow.llm import audit, exact, lines, mixing, packing, quality, secrets, simhash, spans, topk, toxicity, tries, urls
from clinflow.sources.feeds import read_table

Query = Callable[[SparkSession, str], DataFrame]

REGISTERED: dict[str, Query] = {}


def query(run: Query) -> Query:
    REGISTERED[run.__name__] = run
    return run


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, f"{folder}/documents.parquet")


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, f"{folder}/labels.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_quality(spark, folder):
    docs = _documents(spark, folder)
    return quality.score_quality(docs, quality.fit(docs, _labels(spark, folder)))


@query
def op2_simhash(spark, folder):
    found = simhash.near_duplicates(_documents(spark, folder), shingle=3, radius=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op3_lines(spark, folder):
    found = lines.drop_repeated_lines(_documents(spark, folder).select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op4_mixing(spark, folder):
    rows = mixing.sized_rows(_documents(spark, folder), mixing.label_weights(_labels(spark, folder)))
    return mixing.mix(rows).select("doc_id", "size", "source_size", "target", "taken")


@query
def op5_toxicity(spark, folder):
    docs = _documents(spark, folder)
    found = toxicity.score_toxicity(docs, toxicity.fit(docs, _labels(spark, folder)))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))


@query
def op6_exact(spark, folder):
    return exact.exact_duplicates(spark, f"{folder}/documents.parquet")


@query
def op7_spans(spark, folder):
    return spans.drop_repeated_spans(_documents(spark, folder))


@query
def op8_topk(spark, folder):
    return topk.top_k(read_table(spark, f"{folder}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


@query
def op9_packing(spark, folder):
    settings = packing.PackSettings(tokenizer_path(), with_ids=False)
    return packing.pack(_documents(spark, folder), settings).drop("ids")


@query
def op10_secrets(spark, folder):
    found = secrets.scan(_documents(spark, folder))
    counts = [secrets.counted("base", kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    digest = F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, secrets.listed(F.concat("base", "added")).alias("spans"))


@query
def op11_urls(spark, folder):
    return urls.judge_urls(read_table(spark, f"{folder}/pages.parquet"))


@query
def op12_audit(spark, folder):
    return audit.audit(_documents(spark, folder), _labels(spark, folder))


@query
def op13_trie(spark, folder):
    return tries.conversation_trie(read_table(spark, f"{folder}/conversations.parquet"))


_LINES_SQL = """
with
pieces as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place
    from documents
),
keyed as (
    select doc_id, place, line,
           translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from pieces
),
repeated as (
    select key, max(doc_id) as keeper from keyed where length(key) >= 20
    group by key having count(distinct doc_id) >= 3
),
marked as (
    select k.doc_id, k.place, k.line, r.key is not null and k.doc_id <> r.keeper as dropped
    from keyed k left join repeated r on k.key = r.key
)
select doc_id, count(*) as n_lines, count(*) filter (dropped) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by place) filter (not dropped), '')) as kept_sha256
from marked group by doc_id
"""

_MIXING_SQL = r"""
with quality as (
    select doc_id, case when max(quality) = 1 then 2.0::double when max(quality) = 0 then 0.5::double end as weight
    from labels where quality is not null group by doc_id
),
sized as (
    select d.doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
           -ln((('0x' || substr(md5(d.doc_id::varchar), 1, 13))::bigint + 0.5::double) / 4503599627370496::double) / coalesce(weight, 1.0::double) as key
    from documents d left join quality q on d.doc_id = q.doc_id
),
sources as (
    select source, sum(size)::bigint as source_size,
           case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight
    from sized group by source
),
reaching as (
    select *, source_size * 3 as cap, (source_size * 3)::double / weight as reach,
           row_number() over (order by (source_size * 3)::double / weight, source nulls last) as place
    from sources
),
levels as (
    select *, (sum(source_size) over () - coalesce(sum(cap) over (order by place rows between unbounded preceding and 1 preceding), 0))::double
              / sum(weight) over (order by place rows between current row and unbounded following) as level
    from reaching
),
aims as (
    select source, source_size,
           least(cap::double, weight * (select arg_min(level, place) from levels where level <= reach)) as target
    from levels
),
budgets as (
    select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as epochs from aims
),
placed as (
    select s.*, source_size, target, epochs, target - epochs * source_size as budget,
           sum(size) over (partition by s.source order by key, doc_id, size rows unbounded preceding) as upto
    from sized s join budgets b on s.source is not distinct from b.source
),
gaps as (
    select *, budget - coalesce(sum(size) filter (upto <= budget) over (partition by source), 0) as gap from placed
),
best as (
    select source, min({'miss': abs(gap - size), 'key': key, 'doc_id': doc_id}) as pick
    from gaps where upto > budget and size > 0 and abs(gap - size) < gap group by source
)
select g.doc_id, g.size, g.source_size, g.target,
       ((g.epochs + case when g.upto <= g.budget or coalesce(b.pick.doc_id = g.doc_id, false) then 1 else 0 end) * g.size)::bigint as taken
from gaps g left join best b on g.source is not distinct from b.source
"""

_EXACT_SQL = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))
"""

_TOPK_SQL = """
with usable as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v, len(embedding) as width
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
),
scored as (
    select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
    from usable q join usable c on q.width = c.width and q.vec_id <> c.vec_id
    where q.vec_id % 50 = 0
),
ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""



def _glob_regex(glob: str) -> str:
    """The glob as a regular expression, for SQL."""
    letters, runs = urls.parsed(glob)
    out = []
    for place in range(len(letters) + 1):
        if place in runs:
            out.append(".*" if runs[place] else "[^/]*")
        if place < len(letters):
            out.append("[^/]" if letters[place] is None else re.escape(letters[place]))
    return "(?s)" + "".join(out)


def _urls_sql() -> str:
    rules = urls.UrlSettings().ordered()

    def fits(rule: urls.HostRule) -> str:
        return f"(host = '{rule.host}' or ends_with(host, '.{rule.host}')) and starts_with(path, '{rule.path}')"

    def choice(value: str) -> str:
        return "case " + " ".join(f"when {fits(rule)} then '{getattr(rule, value)}'" for rule in rules) + " end"

    globs = ", ".join(f"case when regexp_full_match(host || path, '{_glob_regex(glob)}') then '{glob}' end" for glob in urls.GLOBS)
    return f"""
with rests as (
    select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) end as rest from pages
),
parts as (
    select page_id,
           coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
           coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path
    from rests
),
judged as (
    select *, {choice("text")} as rule, {choice("action")} as action, concat_ws(' ', {globs}) as globs from parts
)
select page_id, host, path, rule, coalesce(action, case when globs <> '' then 'block' else 'allow' end) as verdict, globs from judged
"""


_AUDIT_SQL = """
with texts as (
    select doc_id, coalesce(source, '') as part, coalesce(text, '') as text from documents
),
worded as (
    select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words from texts
),
marked as (
    select doc_id, coalesce(max(quality) = 1, false) as good, coalesce(max(toxic) = 1, false) as toxic from labels group by doc_id
),
masked as (
    select w.doc_id, part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
           (case when len(words) < 200 then 1 else 0 end)
           + (case when 100 * len(list_distinct(words)) < 50 * len(words) then 2 else 0 end)
           + (case when 100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text) then 4 else 0 end)
           + (case when regexp_matches(text, '[#$%&*|]') then 8 else 0 end)
           + (case when w.doc_id > min(w.doc_id) over (partition by text) then 16 else 0 end) as mask
    from worded w left join marked m on w.doc_id = m.doc_id
),
counted as (
    select part, mask, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from masked group by part, mask
),
letters as (
    select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) as l(letter, bit)
),
orders as (
    select a.letter || b.letter || c.letter || d.letter || e.letter as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
    from letters a, letters b, letters c, letters d, letters e
    where len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5
),
steps as (
    select filter_order, step::int as step, bits[step] as bit, coalesce(list_sum(bits[1:step - 1]), 0)::int as earlier
    from orders, range(1, 6) r(step)
),
found as (
    select part, filter_order, step, bit,
           coalesce(sum(n) filter (mask & (earlier | bit) = 0), 0)::bigint as kept,
           coalesce(sum(n) filter (mask & earlier = 0 and mask & bit > 0), 0)::bigint as removed,
           coalesce(sum(n) filter (mask & earlier > 0 and mask & bit > 0), 0)::bigint as redundant,
           coalesce(sum(n) filter (mask = bit), 0)::bigint as unique_fails,
           coalesce(sum(good) filter (mask & earlier = 0 and mask & bit > 0), 0)::bigint as good_lost,
           coalesce(sum(toxic) filter (mask & earlier = 0 and mask & bit > 0), 0)::bigint as toxic_lost
    from steps, counted group by part, filter_order, step, bit
)
select * exclude bit, (sum(removed) over (partition by part, bit))::bigint as shapley from found
"""


def _crc_nibbles() -> str:
    """The 16 entries of CRC-32 for four bits at a time."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return "[" + ", ".join(f"{value}::bigint" for value in table) + "]"


def _trie_sql() -> str:
    def half(crc: str) -> str:
        return f"xor({crc} >> 4, {_crc_nibbles()}[({crc} & 15) + 1])"

    crc = half("(" + half("xor(c, b)") + ")")
    return f"""
with keyed as (
    select conv_id, turn, md5(coalesce(role, '') || chr(31) || coalesce(text, '')) as id,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as words
    from conversations where conv_id is not null
),
lists as (
    select conv_id, list({{'id': id, 'words': words}} order by turn nulls first, id) as turns from keyed group by conv_id
),
opened as (
    select *, (xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
                               lambda c, b: {crc}), 4294967295::bigint) % 4)::bigint as h
    from lists
),
rebuilt as (
    select o.conv_id, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) as turns
    from opened o left join lists b on b.conv_id = o.conv_id - o.conv_id % 20
),
members as (
    select conv_id, d, md5(list_transform(turns[1:d], lambda t: t.id)::varchar) as key,
           case when d > 0 then md5(list_transform(turns[1:d - 1], lambda t: t.id)::varchar) end as parent,
           case when d > 0 then turns[d].words else 0 end as words, d = len(turns) as last
    from (select conv_id, turns, unnest(range(0, len(turns) + 1)) as d from rebuilt)
),
nodes as (
    select d, key, any_value(parent) as parent, any_value(words) as words, min(conv_id) as conv_id, count(*) as n_convs,
           sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (last), '')) as ends_sha256
    from members group by d, key
),
children as (
    select d - 1 as d, parent as key, count(*) as n_children from nodes where d > 0 group by 1, 2
),
known as (
    select n.*, coalesce(c.n_children, 0) as n_children from nodes n left join children c on n.d = c.d and n.key = c.key
),
below as (
    select distinct a.d, a.key, b.d as below_d, b.key as below_key from members a join members b on a.conv_id = b.conv_id and b.d >= a.d
),
summed as (
    select b.d, b.key, count(*) filter (k.n_children = 0) as n_leaves, sum((k.n_convs - 1) * k.words)::bigint as saved_tokens
    from below b join known k on k.d = b.below_d and k.key = b.below_key group by b.d, b.key
)
select k.conv_id, k.d::bigint as depth, p.conv_id as parent_conv_id, k.n_convs, k.n_children, s.n_leaves, s.saved_tokens, k.ends_sha256
from known k join summed s on k.d = s.d and k.key = s.key left join nodes p on p.d = k.d - 1 and p.key = k.parent
"""


ORACLES: dict[str, str] = {
    "op3_lines": _LINES_SQL,
    "op4_mixing": _MIXING_SQL,
    "op6_exact": _EXACT_SQL,
    "op8_topk": _TOPK_SQL,
    "op11_urls": _urls_sql(),
    "op12_audit": _AUDIT_SQL,
    "op13_trie": _trie_sql(),
}
