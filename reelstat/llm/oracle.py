"""DuckDB SQL for the queries of this subpackage that SQL can express on whole tables."""

from __future__ import annotations


def _vector_rounds(rounds: int) -> str:
    """The assignments ``near0`` ... and codebooks ``book0`` ... of all rounds, and the last assignment."""
    out = []
    for r in range(rounds + 1):
        out.append(f"""
near{r} as materialized (
  select i, p, min(d * 256 + e) % 256 as e, min(d * 256 + e) // 256 as d
  from (select c.i, c.p, b.e, sum((c.v - b.v) * (c.v - b.v))::bigint as d from cells c join book{r} b using (p, j) group by all)
  group by i, p)""")
        if r < rounds:
            out.append(f"""
book{r + 1} as materialized (
  select b.p, b.e, b.j, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, b.v) as v
  from book{r} b left join (
    select p, e, j, sum(v)::bigint as s, count(*) as n from near{r} join cells using (i, p) group by all) m using (p, e, j))""")
    return ",".join(out)


VECTOR_CODES = f"""
with kept as materialized (
  select row_number() over (order by vec_id) - 1 as i, vec_id, label,
    list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as c
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
cells as materialized (
  select i, k // size as p, k % size as j, v
  from (select i, unnest(c) as v, unnest(range(len(c))) as k, len(c) // 4 as size from kept)),
book0 as (select p, i as e, j, v from cells where i < 256),
{_vector_rounds(4)},
coded as (select i, string_agg(printf('%02x', e), '' order by p) as code, sum(d)::bigint as error from near4 group by i),
books as (select sha256(string_agg(v::varchar, ',' order by p, e, j)) as codebooks_sha256 from book4)
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256
from coded join kept using (i) cross join books
"""

_LEAF = " || ".join(f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')" for c in ("doc_id", "source", "lang", "n_chars"))


def _tree(name: str, leaves: str) -> str:
    """Nodes (tree, lvl, pos, h, n) above ``leaves`` (tree, pos, h), and the siblings of each."""
    return f"""
{name}(tree, lvl, pos, h, n) as (
  select tree, 0, pos, h, count(*) over (partition by tree) from {leaves}
  union all
  select tree, lvl + 1, pos // 3, sha256(string_agg(h, '' order by pos)), (n + 2) // 3
  from {name} where n > 1 group by tree, lvl, pos // 3, n),
{name}_beside as materialized (
  select a.tree, a.lvl, a.pos, coalesce(string_agg(b.h, '' order by b.pos) filter (b.pos < a.pos), '') as l,
    coalesce(string_agg(b.h, '' order by b.pos) filter (b.pos > a.pos), '') as r
  from {name} a join {name} b on a.tree = b.tree and a.lvl = b.lvl and a.pos // 3 = b.pos // 3
  where a.n > 1 group by all)"""


def _folded(name: str, start: str, tree: str) -> str:
    """The last node (k, h) of each path from ``start`` (k, tree, pos, h), and the siblings beside the path."""
    return f"""
{name}(k, tree, lvl, pos, h, proof) as (
  select k, tree, 0, pos, h, '' from {start}
  union all
  select f.k, f.tree, f.lvl + 1, f.pos // 3, sha256(l || h || r), proof || l || r
  from {name} f join {tree}_beside s on f.tree = s.tree and f.lvl = s.lvl and f.pos = s.pos),
{name}_end as (select k, arg_max(h, lvl) as h, arg_max(proof, lvl) as proof from {name} group by k)"""


MERKLE = f"""
with recursive crc as (
  select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, s: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end)) as t),
docs as materialized (
  select row_number() over () as k, doc_id, coalesce('=' || source, '-') as tree,
    {_LEAF} as head, text,
    coalesce(xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 2 = 0, false) as changed
  from documents cross join crc),
hashed as materialized (
  select k, doc_id, tree, changed, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as h,
    sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) as cut
  from docs),
leaves as materialized (
  select *, row_number() over (partition by tree order by doc_id nulls first, h, k) - 1 as pos from hashed),
{_tree("low", "leaves")},
subroots as materialized (
  select tree as source, '' as tree, row_number() over (order by encode(tree)) - 1 as pos, h from low where n = 1),
{_tree("high", "subroots")},
changes as (select k, tree, pos, case when changed then cut else h end as h from leaves),
{_folded("up", "changes", "low")},
tops as (
  select e.k, s.tree, s.pos, e.h, e.proof as below from up_end e join leaves f on e.k = f.k join subroots s on f.tree = s.source),
{_folded("over", "tops", "high")},
root as (select h as root from high where n = 1)
select f.doc_id, f.h as leaf, s.h as subroot, root, sha256(t.below || o.proof) as proof_sha256, o.h as folded_root, o.h = root as verified
from leaves f join subroots s on f.tree = s.source join tops t on f.k = t.k join over_end o on f.k = o.k cross join root
"""

WARC = """
with p as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest, coalesce(html, '') as html from pages),
first as (select html, max(page_id) as response from p where payload_bytes >= 1000 group by html)
select page_id, payload_bytes, payload_digest, case when page_id < response then 'revisit' else 'response' end as record_type,
  case when page_id < response then response end as refers_to
from p left join first using (html)
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
JACCARD = rf"""
with recursive worded as (
  select row_number() over () as k, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') as w
  from documents),
sets as materialized (
  select k, doc_id, list_sort(list_distinct(case
    when len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end)) as s
  from worded),
named as materialized (
  select doc_id, len(s) as n, min(k) over (partition by md5(array_to_string(s, ' | '))) as node, k from sets),
grams as materialized (
  select k as node, len(s) as n, unnest(s) as gram from sets where k in (select node from named)),
links as materialized (
  select a.node as a, b.node as b
  from grams a join grams b on a.gram = b.gram and a.node <> b.node and 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)
  group by a.node, b.node, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reached(a, b) as (
  select distinct a, a from links
  union
  select r.a, l.b from reached r join links l on r.b = l.a),
least as materialized (select node, min(doc_id) as doc_id from named where n > 0 group by node),
class as (select r.a as node, min(l.doc_id) as doc_id from reached r join least l on r.b = l.node group by r.a)
select d.doc_id, d.n as n_shingles, case when d.n = 0 then d.doc_id else coalesce(c.doc_id, l.doc_id) end as component_id
from named d left join least l using (node) left join class c on d.node = c.node
"""

ORACLES: dict[str, str] = {
    "op6_ngram_jaccard_join": JACCARD,
    "op7_warc": WARC,
    "op11_vector_codes": VECTOR_CODES,
    "op12_merkle_manifest": MERKLE,
}
