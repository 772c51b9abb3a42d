"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from tidepool.llm import license_digest as ld, url_templates as ut
from tidepool.llm.textkernel import WORD_RE


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def components_sql(nodes: str, edges: str) -> str:
    """CTEs reach(node, root) over ``edges(a, b)`` (both directions)."""
    return (f"walk(node, root) as (select id, id from {nodes} union select e.b, w.root from walk w join {edges} e on e.a = w.node), "
            "reach as (select node, min(root) as root from walk group by node)")


def op1_sql(rules: dict[str, str]) -> str:
    t, masked = "", ""
    fit = "null"
    for rule in sorted(rules, key=lambda r: (len(r), [-ord(c) for c in r])):
        h, p = ut.split_rule(rule)
        fit = f"case when (host = {_q(h)} or ends_with(host, {_q('.' + h)})) and starts_with(path, {_q(p)}) then {_q(rule)} else {fit} end"
    verdict = "case rule " + " ".join(f"when {_q(r)} then {_q(v)}" for r, v in rules.items()) + " else method end"
    prev = "p0"
    for i in range(1, ut.LEVELS + 1):
        par = ", ".join(["host", *[f"t{j}" for j in range(1, i)]])
        t += (f"v{i} as (select {par}, s{i}, count(*) as n from {prev} group by all), "
              f"l{i} as (select {par}, s{i}, true as lit from (select *, sum(n) over (partition by {par}) as alln from v{i}) "
              f"where n >= {ut.LEAST} and s{i} <> '' and n >= alln * {ut.SHARE}::double), "
              f"p{i} as (select {prev}.*, case when s{i} = '' then '' when lit then s{i} else '*' end as t{i} "
              f"from {prev} left join l{i} using ({par}, s{i})), ")
        prev = f"p{i}"
    last = "m0"
    masked = (f"m0 as (select host, t1, t2, t3, deep, t1 as m1, t2 as m2, t3 as m3, count(bad) as labelled, "
              f"coalesce(sum(bad), 0) as bad from (select p{ut.LEVELS}.*, bad from p{ut.LEVELS} left join lab using (key)) group by all), ")
    for k, i in enumerate(range(ut.LEVELS, 0, -1), 1):
        names = ["host", "deep", *[f"m{j}" for j in range(1, ut.LEVELS + 1) if j != i]]
        others, on = ", ".join([*names, f"m{i} = ''"]), ", ".join([*names, f"m{i}"])
        differs = (f"n > 0 and pn > 0 and (b * pn - pb * n)::double * (b * pn - pb * n)::double * (n + pn) "
                   f"> {ut.CHI2}::double * (b + pb) * (n + pn - b - pb) * n * pn")
        masked += (
            f"b{k} as (select *, sum(case when {differs} then 1 else 0 end) over (partition by {others} order by rate, m{i} rows unbounded preceding) as cl "
            f"from (select *, lag(n) over o as pn, lag(b) over o as pb from (select {on}, sum(labelled) as n, sum(bad) as b, "
            f"case when sum(labelled) > 0 then sum(bad) / sum(labelled) else -1 end as rate from {last} group by all) "
            f"window o as (partition by {others} order by rate, m{i}))), "
            f"c{k} as (select {on}, case when count(*) over (partition by {others}, cl) = 1 then m{i} "
            f"when count(*) over (partition by {others}, cl) = count(*) over (partition by {others}) then '*' "
            f"else '{{' || array_to_string(list_sort(list(m{i}) over (partition by {others}, cl)), '|') || '}}' end as named from b{k}), "
            f"m{k} as (select {last}.* replace (named as m{i}) from {last} join c{k} using ({on})), ")
        last = f"m{k}"
    parts = " || ".join(f"case when m{i} = '' then '' else '/' || m{i} end" for i in range(1, ut.LEVELS + 1))
    return f"""
with lab as (select doc_id as key, max(greatest(1 - quality, toxic)) as bad from labels
  where doc_id is not null and greatest(1 - quality, toxic) is not null group by all),
base as (select page_id, translate(regexp_extract(coalesce(url, ''), {_q(ut.PARTS)}, 1), '{ut.UPPER}', '{ut.LOWER}') as host,
  regexp_extract(coalesce(url, ''), {_q(ut.PARTS)}, 2) as path from pages),
p0 as (select *, coalesce(segs[1], '') as s1, coalesce(segs[2], '') as s2, coalesce(segs[3], '') as s3, len(segs) > 3 as deep,
  try_cast(nullif(regexp_extract(path, '/([0-9]+)(\\.html)?/?$', 1), '') as bigint) as key
  from (select *, list_filter(string_split(path, '/'), lambda x: x <> '') as segs from base)),
{t}{masked}
prior as (select case when sum(labelled) > 0 then {ut.WEIGHT}::double * (sum(bad) / sum(labelled)) else 0 end as w from m0),
judged as (select host, t1, t2, t3, deep, host || {parts} || case when deep then '/**' else '' end as template,
  case when (sum(bad) over own + w) / (sum(labelled) over own + {ut.WEIGHT}::double) >= {ut.LIMIT}::double then 'block' else 'allow' end as method
  from {last}, prior window own as (partition by host, deep, m1, m2, m3))
select page_id, host, path, rule, {verdict} as verdict, template
from (select *, {fit} as rule from p{ut.LEVELS} join judged using (host, t1, t2, t3, deep))
"""


OP2 = f"""
with recursive v as materialized (select vec_id as id, list_transform(embedding, lambda x: x::double) as e from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
  and len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs as materialized (select x.id as a, y.id as b from v x join v y on x.id <> y.id where list_cosine_similarity(x.e, y.e) >= 0.9),
nodes as (select vec_id as id from embeddings),
{components_sql("nodes", "pairs")}
select vec_id, (select count(*) from pairs p where p.a = vec_id)::bigint as n_links, root as component_id,
  vec_id = root as kept from embeddings join reach on node = vec_id
"""


def _canonical(text: str) -> str:
    t = f"regexp_replace(chr(10) || lower(coalesce({text}, '')), {_q(ld.COPYRIGHT_LINE)}, '', 'g')"
    t = f"(' ' || regexp_replace({t}, {_q(ld.SIGNS)}, ' ', 'g') || ' ')"
    for a, b in ld.EQUIVALENT:
        t = f"replace({t}, {_q(a)}, {_q(b)})"
    return f"trim({t})"


_KNOWN = (f"known as (select digest, min(licence) as licence from (select md5({_canonical('t')}) as digest, licence from (values "
          + ", ".join(f"({_q(n)}, {_q(t)})" for n, t in ld.KNOWN) + ") as k(licence, t)) group by digest)")
_WHOLE = f"(select doc_id, md5({_canonical('text')}) as digest from documents) left join known using (digest)"

OP5 = f"with {_KNOWN} select doc_id, digest, licence from {_WHOLE}"

OP5_NOTICES = f"""
with {_KNOWN},
lines as (select doc_id, unnest(string_split(text, chr(10))) as line from documents where text is not null),
found as (select distinct doc_id, licence from (select doc_id, md5({_canonical("line")}) as digest from lines) join known using (digest)),
notes as (select doc_id as id, string_agg(licence, ',' order by licence) as notices from found group by doc_id)
select doc_id, digest, licence, coalesce(notices, '') as notices from {_WHOLE} left join notes on doc_id is not distinct from id
"""


def _shingles(table: str, key: str) -> str:
    """Distinct five-word shingles (key, s) of a table's texts."""
    rest = ", ".join(f"lead(w, {i}) over o" for i in range(1, 5))
    return (f"(select distinct {key}, s from (select {key}, pos, n, concat_ws(' ', w, {rest}) as s from "
            f"(select {key}, rid, unnest(ws) as w, unnest(range(1, len(ws) + 1)) as pos, len(ws) as n from "
            f"(select {key}, row_number() over () as rid, regexp_extract_all(lower(text), {_q(WORD_RE)}) as ws from {table} "
            f"where {key} is not null and text is not null)) window o as (partition by rid order by pos)) "
            f"where pos + 4 <= n or (n < 5 and pos = 1))")


OP6 = f"""
with recursive sh as materialized {_shingles("documents", "doc_id")},
n as (select doc_id, count(*) as n from sh group by all),
pairs as materialized (select a, b from (select x.doc_id as a, y.doc_id as b, count(*) as c from sh x join sh y using (s)
  where x.doc_id <> y.doc_id group by all) join n na on na.doc_id = a join n nb on nb.doc_id = b
  where c >= 0.8::double * (na.n + nb.n - c) - 1e-9),
same as (select doc_id, min(doc_id) over (partition by f) as class_id from
  (select doc_id, md5(string_agg(s, chr(10) order by s)) as f from sh group by doc_id)),
nodes as (select distinct doc_id as id from documents where doc_id is not null),
links as (select a, count(*) as c from pairs group by a),
{components_sql("nodes", "pairs")}
select d.doc_id, coalesce(class_id, d.doc_id) as class_id, coalesce(c, 0)::bigint as n_links, root as component_id,
  coalesce(d.doc_id = root, true) as kept
from documents d left join same using (doc_id) left join links on a = d.doc_id left join reach on node = d.doc_id
"""

OP9 = f"""
with ds as {_shingles("documents", "doc_id")}, bs as {_shingles("benchmark", "item_id")},
size as (select item_id, count(*) as n from bs group by all)
select doc_id, item_id, count(*)::bigint as shared, any_value(n)::bigint as item_shingles, count(*)::double / any_value(n) as containment
from ds join bs using (s) join size using (item_id) group by doc_id, item_id having count(*) >= 0.8::double * any_value(n) - 1e-9
"""

OP10 = """
with p as (select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha1(coalesce(html, '')) as h from pages),
g as (select *, array_to_string(list_transform(string_split(h, ''), lambda c: lpad(bin(('0x' || c)::int), 4, '0')), '') as bits,
  max(page_id) over (partition by h) as best from p)
select page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
    16 * substr(bits, 5 * i + 1, 1)::int + 8 * substr(bits, 5 * i + 2, 1)::int + 4 * substr(bits, 5 * i + 3, 1)::int
    + 2 * substr(bits, 5 * i + 4, 1)::int + substr(bits, 5 * i + 5, 1)::int)::int, 1)), '') as payload_digest,
  case when page_id <> best then 'revisit' else 'response' end as record_type,
  case when page_id <> best then best end as refers_to from g
"""

OP12 = r"""
with t as (select doc_id, length(coalesce(text, '')) as n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as x from documents),
g as (select doc_id, x, first_value(doc_id) over (partition by x order by n desc, doc_id) as keep_id, count(*) over (partition by x) as group_size from t)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(x) as text_sha256 from g
"""
