"""DuckDB SQL for the operators whose results SQL can express."""

from __future__ import annotations

_UNIT = """usable as (
  select vec_id, cast(embedding as double[]) as v from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0)"""

OP2 = r"""with recursive docs as materialized (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
shingles as materialized (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) = 1 then [w[1]]
           else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) as s
  from docs),
sizes as materialized (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as materialized (
  select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * c >= 80 * (x.n + y.n - c)),
ways as materialized (select a, b from links union all select b, a from links),
reach(a, b) as (select a, b from ways union select reach.a, ways.b from reach join ways on reach.b = ways.a),
lowest as (select a as doc_id, min(b) as m from reach group by a)
select docs.doc_id, coalesce(n, 0) as n_shingles, least(docs.doc_id, coalesce(m, docs.doc_id)) as component_id,
       docs.doc_id <= coalesce(m, docs.doc_id) as kept
from docs left join sizes on docs.doc_id = sizes.doc_id left join lowest on docs.doc_id = lowest.doc_id"""

_DOT = "list_reduce(list_transform(range(1, len({0}) + 1), lambda i: {0}[i] * {1}[i]), lambda s, x: s + x)"

OP7 = f"""with {_UNIT},
numbered as (select vec_id, v, row_number() over () as number, sqrt({_DOT.format("v", "v")}) as norm from usable),
scored as (
  select q.number, q.vec_id as query_id, c.vec_id, {_DOT.format("q.v", "c.v")} / (q.norm * c.norm) as score
  from numbered q join numbered c on q.number <> c.number
  where q.vec_id % 50 = 0),
ranked as (
  select query_id, vec_id, score,
         row_number() over (partition by number order by score desc, vec_id) as r
  from scored)
select query_id, cast(r as integer) as rank, vec_id, score from ranked where r <= 5"""

OP9 = r"""with recursive docs as materialized (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
         cast(('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))), 1, 9)) as bigint) as number
  from documents),
sources as materialized (
  select source, cast(sum(size) as bigint) as source_size,
         case (row_number() over (order by source nulls last) - 1) % 3
           when 0 then 5e0 when 1 then 2e0 else 1e0 end as weight
  from docs group by source),
shared(turn, source, source_size, weight, target, capped) as (
  select 0, source, source_size, weight, 0e0, false from sources
  union all
  select turn + 1, source, source_size, weight,
         case when capped or share >= 3e0 * source_size then 3e0 * source_size else share end,
         capped or share >= 3e0 * source_size
  from (select *, (sum(source_size) over () - coalesce(sum(case when capped then 3e0 * source_size end) over (), 0))
               * weight / nullif(sum(case when not capped then weight end) over (), 0) as share
        from shared)
  where turn < (select count(*) + 1 from sources)),
targets as materialized (
  select source, source_size, target, cast(floor(target / greatest(source_size, 1)) as integer) as whole,
         target - floor(target / greatest(source_size, 1)) * source_size as budget
  from shared where turn = (select count(*) + 1 from sources)),
numbers as materialized (
  select source, number, sum(size) as n,
         sum(sum(size)) over (partition by source order by number) - sum(size) as before
  from docs group by source, number),
lasts as (
  select t.source, max_by(number, number) as number, max_by(n, number) as n,
         max_by(before, number) as before, any_value(budget) as budget
  from numbers join targets t on numbers.source is not distinct from t.source
  where before <= budget group by t.source)
select doc_id, size, t.source_size, round(t.target, 6) as target,
       cast(size * (whole + case when docs.number < l.number
         or docs.number = l.number and 2 * (l.budget - l.before) >= l.n then 1 else 0 end) as bigint) as taken
from docs join targets t on docs.source is not distinct from t.source
  join lasts l on docs.source is not distinct from l.source"""

_LEAF = "sha256({})".format(
    " || ".join(
        f"coalesce(strlen({c}) || ':' || {c}, '-')"
        for c in ("cast(doc_id as varchar)", "source", "lang", "cast(n_chars + {more} as varchar)", "text")
    )
)


def _tree(name: str, leaves: str) -> str:
    """All nodes of the trees over ``leaves`` (tree, place, n, hash, claimed), and what each leaf's claim leads to."""
    return f"""{name}_nodes(level, tree, place, n, hash) as (
  select 0, tree, place, n, hash from {leaves}
  union all
  select level + 1, tree, place // 2, (n + 1) // 2, sha256(string_agg(hash, '' order by place))
  from {name}_nodes where n > 1 group by level, tree, place // 2, n),
{name}_all as materialized (select * from {name}_nodes),
{name}_paths(level, tree, leaf_at, place, n, proof, folded) as (
  select 0, tree, place, place, n, '', claimed from {leaves}
  union all
  select p.level + 1, p.tree, leaf_at, p.place // 2, (p.n + 1) // 2, proof || coalesce(s.hash, ''),
         sha256(case when s.hash is null then folded when p.place % 2 = 1 then s.hash || folded else folded || s.hash end)
  from {name}_paths p left join {name}_all s on s.level = p.level and s.tree is not distinct from p.tree and s.place = xor(p.place, 1)
  where p.n > 1),
{name}_ends as materialized (select tree, leaf_at, proof, folded from {name}_paths where n = 1)"""


OP13 = f"""with recursive steps as (
  select list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, z: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end)) as t),
codes as (select *, list_transform(string_split(cast(doc_id as varchar), ''), lambda x: cast(ascii(x) as bigint)) as b from documents),
hashed as (
  select *, xor(list_reduce([4294967295] || b, lambda c, x: xor(c // 256, t[xor(c, x) % 256 + 1])), 4294967295) as crc from codes, steps),
leaves as materialized (
  select doc_id, lang as tree, {_LEAF.format(more="0")} as hash,
         {_LEAF.format(more="case when crc % 7 = 0 then 1 else 0 end")} as claimed,
         row_number() over (partition by lang order by doc_id nulls first) - 1 as place, count(*) over (partition by lang) as n
  from hashed),
{_tree("own", "leaves")},
subroots as materialized (
  select true as tree, tree as lang, hash, hash as claimed, row_number() over (order by tree nulls first) - 1 as place, count(*) over () as n
  from own_all where n = 1),
{_tree("top", "subroots")},
folds(level, tree, leaf_at, place, n, folded) as (
  select 0, e.tree, e.leaf_at, s.place, s.n, e.folded from own_ends e join subroots s on s.lang is not distinct from e.tree
  union all
  select f.level + 1, f.tree, leaf_at, f.place // 2, (f.n + 1) // 2,
         sha256(case when s.hash is null then folded when f.place % 2 = 1 then s.hash || folded else folded || s.hash end)
  from folds f left join top_all s on s.level = f.level and s.place = xor(f.place, 1) where f.n > 1)
select l.doc_id, l.hash as leaf, o.hash as subroot, r.hash as root, sha256(e.proof || t.proof) as proof_sha256,
       f.folded as folded_root, f.folded = r.hash as verified
from leaves l join subroots o on o.lang is not distinct from l.tree
  join own_ends e on e.tree is not distinct from l.tree and e.leaf_at = l.place
  join top_ends t on t.leaf_at = o.place
  join folds f on f.tree is not distinct from l.tree and f.leaf_at = l.place and f.n = 1
  cross join (select hash from top_all where n = 1) r"""

ORACLES = {"op2_tensor_minhash": OP2, "op7_vantage_trees": OP7, "op9_hash_mixture": OP9, "op13_merkle_manifest": OP13}
