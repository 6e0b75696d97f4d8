"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import chat, fingerprints, line_runs, secret_scan

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_TOP_K = """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings
    where vec_id is not null and embedding is not null
      and coalesce(list_aggregate(list_transform(embedding, lambda x: x is not null and isfinite(x)), 'bool_and'), true)
), scored as (
    select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
    from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0
)
select query_id, rank, vec_id, score from (
    select *, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank from scored
) where rank <= 20
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secrets() -> str:
    cuts = []
    for kind, (pattern, group, least) in (secret_scan.BASE | secret_scan.WEAK | {"|": (secret_scan.SCOPE_END, 0, 1)}).items():
        p = _quoted(pattern)
        opaque = " and regexp_matches(own, '[0-9]') and regexp_matches(own, '[A-Z]') and regexp_matches(own, '[a-z]')"
        cuts.append(f"""
        select doc_id, '{kind}' as kind, stop - length(hit) as start, stop as "end" from (
            select *, sum(length(gap) + length(hit)) over (partition by doc_id order by i)::bigint as stop from (
                select doc_id, unnest(range(len(hits))) as i, unnest(hits) as hit, unnest(gaps[1:len(hits)]) as gap,
                       unnest(owns) as own
                from (select doc_id, regexp_extract_all(t, {p}, 0) as hits, regexp_extract_all(t, {p}, {group}) as owns,
                             string_split_regex(t, {p}) as gaps from docs)))
        where length(own) >= {least}{opaque if kind == "opaque" else ""}""")
    ranks = ", ".join(f"'{k}'" for k in secret_scan.KINDS)
    near = lambda kinds: f"""exists (select 1 from inner_ p where p.doc_id = w.doc_id and p.scope = w.scope
        and p.kind in ({kinds}) and not p.inside and (p."end" <= w.start or p.start >= w."end"))"""  # noqa: E731
    identifier, secret, endpoint = near("'access', 'client'"), near("'assign', 'hex', 'opaque'"), near("'endpoint'")
    base = ", ".join(f"'{k}'" for k in secret_scan.BASE)
    return f"""
with docs as (select doc_id, coalesce(text, '') as t from documents),
found as ({" union all ".join(cuts)}),
part as (
    select f.*, list_position([{ranks}], kind) as place, row_number() over (order by doc_id, start, list_position([{ranks}], kind)) as id,
           (select count(*) from found b where b.doc_id = f.doc_id and b.kind = '|' and b."end" <= f.start) as scope
    from found f where kind <> '|'
),
inner_ as (
    select *, kind = 'opaque' and exists (select 1 from part e where e.doc_id = o.doc_id and e.kind = 'endpoint'
                                          and e.start <= o.start and e."end" >= o."end") as inside from part o
),
kept as (
    select * from inner_ w where kind in ({base})
    or (not exists (select 1 from part b where b.doc_id = w.doc_id and b.kind in ({base}) and b.start < w."end" and b."end" > w.start)
        and ((kind = 'client' and {secret}) or (kind = 'opaque' and ({identifier} or case when inside then {secret} else {endpoint} end))
             or (kind = 'endpoint' and {identifier} and {secret})))
),
told as (
    select doc_id, {", ".join(f"count(*) filter (kind = '{k}') as n_{k}" for k in secret_scan.BASE)},
           coalesce(string_agg(kind || ':' || start || ':' || "end", ',' order by start, place) filter (kind in ({base})), '') as base,
           string_agg(kind || ':' || start || ':' || "end", ',' order by start, place) as spans
    from kept group by doc_id
)
select d.doc_id, {", ".join(f"coalesce(n_{k}, 0)::bigint as n_{k}" for k in secret_scan.BASE)},
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from docs d left join told on d.doc_id = told.doc_id
"""


def _kept(text: str) -> str:
    n = fingerprints.SHINGLE
    words = f"list_filter(regexp_split_to_array(translate({text}, '{_CAPITALS}', '{_SMALL}'), '{fingerprints.BLANKS}'), lambda w: w <> '')"
    return f"""(select case when len(w) = 0 then []::varchar[] else list_sort(list_distinct(list_filter(
        list_transform(range(1, greatest(len(w) - {n - 1}, 1) + 1),
                       lambda i: left(md5(array_to_string(w[i : i + {n - 1}], ' ')), {fingerprints.HEX_DIGITS})),
        lambda h: h < '{fingerprints.KEPT}'))) end from (select {words} as w))"""


def _like(a: str, b: str, same: str) -> str:
    common = f"len(list_intersect({a}, {b}))"
    return f"""case when {same} then 1.0 when len({a}) + len({b}) - {common} > 0
        then {common}::double / (len({a}) + len({b}) - {common}) else 0.0 end::double"""


_FINGERPRINTS = f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
o as (select *, coalesce(lead(t) over w, first_value(t) over w) as next_t from d window w as (order by doc_id desc nulls last, t)),
e as (select *, length(t) as n, left(t, (length(t) - length(t) // 3)::bigint) || left(next_t, (length(t) // 3)::bigint) as edited from o),
k as (select *, {_kept("t")} as own, {_kept("edited")} as ed, {_kept("next_t")} as nx from e)
select doc_id, n as n_chars, sha256(edited) as edited_sha256,
       md5(t) || ':' || array_to_string(own, '') as fingerprint,
       md5(edited) || ':' || array_to_string(ed, '') as edited_fingerprint,
       {_like("own", "ed", "t = edited")} as near_edited, {_like("own", "nx", "t = next_t")} as near_next
from k
"""

_NEAR_COPIES = f"""
with recursive w as (
    select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_CAPITALS}', '{_SMALL}'),
                                                     '{fingerprints.BLANKS}'), lambda x: x <> '') as w from documents
),
s as (
    select distinct doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
                                                  lambda i: array_to_string(w[i : i + 4], ' '))) as shingle
    from w where len(w) > 0
),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
both_ways as (select a, b from l union all select b, a from l),
r as (select doc_id, doc_id as other from documents union select r.doc_id, b from r join both_ways on other = a),
c as (select doc_id, min(other) as component_id from r group by doc_id)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, doc_id = component_id as kept
from c left join n using (doc_id)
"""


def _escaped(text: str) -> str:
    return f"replace(replace(replace({text}, '\\', '\\\\'), '<', '\\l'), '[', '\\b')"


_MARKS = len(chat.TURN + chat.BODY + chat.END)
_CHATS = f"""
with t as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum({_MARKS} + length({_escaped("role")}) + length({_escaped("text")}))::bigint as formatted_chars
from t group by conv_id
"""

_LINES = f"""
with l as (
    select rid, doc_id, unnest(range(1, len(ls) + 1)) as pos, unnest(ls) as line
    from (select row_number() over () as rid, doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents)
),
k as (
    select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_CAPITALS}', '{_SMALL}') as key from l
),
s as (select key, min(doc_id) as owner from k where length(key) >= {line_runs.LEAST_CHARS} group by key having count(distinct doc_id) > 1),
m as (select k.*, owner is not null and doc_id > owner as gone from k left join s using (key))
select any_value(doc_id) as doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from m group by rid
"""

_NEGATIVES = """
with v as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and coalesce(list_aggregate(list_transform(embedding, lambda x: x is not null and isfinite(x)), 'bool_and'), false)
),
a as (select row_number() over () as key, * from (select distinct * from v where vec_id % 100 = 0)),
s as (
    select distinct a.key, a.vec_id as anchor_id, c.vec_id as id, a.label = c.label as same, list_inner_product(a.v, c.v)::bigint as score
    from a join v c on len(a.v) = len(c.v) and (a.vec_id <> c.vec_id or a.label <> c.label)
),
p as (
    select key, anchor_id, id as positive_id, score as positive_score from (
        select *, row_number() over (partition by key order by score desc, id) as r from s where same and anchor_id <> id)
    where r <= 5
),
n as (
    select p.*, s.id as negative_id, s.score as negative_score,
           (row_number() over (partition by p.key, positive_id, positive_score order by s.score desc, s.id))::int as rank
    from p join s on s.key = p.key and not s.same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 10
"""

SQL: dict[str, str] = {
    "op1_segment_topk": _TOP_K,
    "op3_secret_links": _secrets(),
    "op4_fingerprints": _FINGERPRINTS,
    "op6_minhash_dedup": _NEAR_COPIES,
    "op8_chat_format": _CHATS,
    "op11_line_dedup": _LINES,
    "op13_hard_negatives": _NEGATIVES,
}
