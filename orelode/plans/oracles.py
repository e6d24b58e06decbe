"""The same results in plain SQL (DuckDB), written independently of the operators.

Only queries whose result SQL can express are here.
"""

from __future__ import annotations

from orelode.operators.als import LAMBDA
from orelode.plans.inputs import CENTERS, F4, KEY, SCALED, SEED, STEP_CENTERS
from orelode.plans.queries import (
    ALS_ROWS_ITERATIONS,
    ALS_SPARSE_SHARE,
    BUCKETS,
    HEADER,
    MIN_DOC_FREQ,
    PASSES,
    TRAIN_SHARE,
)

KEY_LIST = ", ".join(KEY)
INT_KEYS = ("l_linenumber", '"user"', "item")
_QTY_KEY = "cast(l_quantity as bigint) as qty_key"
_ITEM_KEY = f"{', '.join(KEY[:4])}, {_QTY_KEY}"

ITEMS = f"items as materialized (select {_ITEM_KEY}, {', '.join(F4)} from lineitem)"

SCALED_ITEMS = f"""items as materialized (
  select {_ITEM_KEY}, l_returnflag as label, l_quantity as quantity,
         l_extendedprice / cast(1000 as double) as price_k,
         l_discount * cast(100 as double) as discount_pct,
         l_tax * cast(100 as double) as tax_pct
  from lineitem)"""

EMB = """emb as materialized (
  select vec_id, cast(unnest(range(64)) as integer) as pos,
         cast(unnest(embedding) as double) as x
  from embeddings)"""

RATINGS = """ratings as materialized (
  select cast(o_custkey as integer) as "user", cast(l_partkey as integer) as item,
         sum(l_quantity) as rating
  from lineitem join orders on l_orderkey = o_orderkey
  group by 1, 2)"""

FLOWER_NAME = """case event_type when 'click' then 'Iris-setosa'
  when 'view' then 'Iris-versicolor' else event_type end"""


# The multipliers of the 64-bit hash (XXH64).
P1, P2, P3 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
P4, P5 = 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
WORD = 2**64


def _times(a: str, factor: int) -> str:
    return f"((({a}) * {factor}::uhugeint) & {WORD - 1}::uhugeint)"


def _turn(a: str, bits: int) -> str:
    return f"({_times(a, 2**bits)} | (({a}) >> {64 - bits}::uhugeint))"


def _fold(a: str, bits: int) -> str:
    return f"xor({a}, ({a}) >> {bits}::uhugeint)"


def _hash_of_seeds(seeds: list[int]) -> int:
    """The state after the seeds, which come first and are the same for all rows."""
    turn = lambda v, r: ((v << r) | (v >> (64 - r))) % WORD
    state = 42
    for seed in seeds:
        x = ((state + P5 + 8) % WORD) ^ (turn(seed * P2 % WORD, 31) * P1 % WORD)
        y = (turn(x, 27) * P1 + P4) % WORD
        z = (y ^ (y >> 33)) * P2 % WORD
        w = (z ^ (z >> 29)) * P3 % WORD
        state = w ^ (w >> 32)
    return state


def with_uniform(source: str, key: list[str], *seeds: int, name: str = "u") -> str:
    """A subquery: ``source`` with the samplers' uniform of key and seeds.

    The hash goes over the key columns one by one; 4-byte integers (INT_KEYS) are
    mixed in another way than 8-byte ones. Every step is a select of its own, as each
    uses the one before twice.
    """
    words = ", ".join(
        (_times(f'{k}::uhugeint', P1) if k in INT_KEYS else _times(f'{k}::uhugeint', P2)) + f" as w{i}"
        for i, k in enumerate(key)
    )
    sql = f"(select *, {_hash_of_seeds(list(seeds))}::uhugeint as s, {words} from {source})"
    for i, k in enumerate(key):
        size, turned = (4, f"w{i}") if k in INT_KEYS else (8, _times(_turn(f"w{i}", 31), P1))
        start = f"((s + {P5 + size}::uhugeint) & {WORD - 1}::uhugeint)"
        sql = f"(select * exclude (s), xor({start}, {turned}) as x from {sql})"
        bits, factor, plus = (23, P2, P3) if k in INT_KEYS else (27, P1, P4)
        mixed = f"(({_times(_turn('x', bits), factor)} + {plus}::uhugeint) & {WORD - 1}::uhugeint)"
        sql = f"(select * exclude (x), {mixed} as y from {sql})"
        sql = f"(select * exclude (y), {_times(_fold('y', 33), P2)} as z from {sql})"
        sql = f"(select * exclude (z), {_times(_fold('z', 29), P3)} as v from {sql})"
        sql = f"(select * exclude (v), {_fold('v', 32)} as s from {sql})"
    dropped = ", ".join(["s", *[f"w{i}" for i in range(len(key))]])
    value = "cast((s >> 12::uhugeint) as double) / cast(4503599627370496 as double)"
    return f"(select * exclude ({dropped}), {value} as {name} from {sql})"


def double(v: float) -> str:
    return f"cast({v!r} as double)"


def centers_cte(name: str, centers: list[list[float]], features: list[str] = F4) -> str:
    rows = " union all ".join(
        f"select {j} as j, " + ", ".join(f"{double(v)} as {f}" for f, v in zip(features, c))
        for j, c in enumerate(centers)
    )
    return f"{name} as materialized ({rows})"


def first_centers_cte(name: str, k: int = 4) -> str:
    return (
        f"{name} as materialized (select cast(row_number() over (order by {KEY_LIST}) - 1 as integer) as j, "
        f"{', '.join(F4)} from (select * from items order by {KEY_LIST} limit {k}))"
    )


def distance(a: str, b: str, features: list[str] = F4) -> str:
    return " + ".join(f"({a}.{f} - {b}.{f}) * ({a}.{f} - {b}.{f})" for f in features)


def assign_cte(name: str, centers: str, features: list[str] = F4) -> str:
    """Every row with its closest centre ``j`` and squared distance ``d``."""
    return f"""{name} as materialized (
  select * from (
    select i.*, c.j, {distance('i', 'c', features)} as d,
           row_number() over (partition by {', '.join('i.' + k for k in KEY)}
             order by {distance('i', 'c', features)}, c.j) as place
    from items i cross join {centers} c)
  where place = 1)"""


def next_centers_cte(name: str, assigned: str, old: str) -> str:
    means = ", ".join(f"avg({f}) as {f}" for f in F4)
    columns = ", ".join(f"coalesce(m.{f}, o.{f}) as {f}" for f in F4)
    return (
        f"{name} as materialized (select o.j, {columns} from {old} o "
        f"left join (select j, {means} from {assigned} group by j) m on m.j = o.j)"
    )


def passes_ctes(passes: int) -> str:
    """Centres c0..cN and assignments a0..a(N-1)."""
    parts = [ITEMS, first_centers_cte("c0")]
    for p in range(passes):
        parts.append(assign_cte(f"a{p}", f"c{p}"))
        parts.append(next_centers_cte(f"c{p + 1}", f"a{p}", f"c{p}"))
    return ",\n".join(parts)


def long_form(source: str, expression: str, features: list[str] = F4, group: str = "") -> str:
    """One select per attribute; ``{f}`` in the expression is its name."""
    return "\nunion all\n".join(
        f"select '{f}' as attribute, {expression.replace('{f}', f)} from {source} {group}" for f in features
    )


def patterns(assigned: str, metrics: str) -> str:
    return long_form(assigned, f"cast(j as integer) as cluster, count(*) as n, {metrics}", group="group by j")


ALL_METRICS = (
    "round(avg({f}), 5) as mean, min({f}) as min, max({f}) as max, round(stddev_samp({f}), 5) as stddev"
)


def emb_assign(name: str, centers: str) -> str:
    return f"""dist as materialized (
  select e.vec_id, c.j, sum((e.x - c.x) * (e.x - c.x)) as d
  from emb e join {centers} c on c.pos = e.pos group by e.vec_id, c.j),
{name} as materialized (
  select vec_id, j, d from (
    select *, row_number() over (partition by vec_id order by d, j) as place from dist)
  where place = 1)"""


EMB_CENTERS = """ec as materialized (
  select cast(dense_rank() over (order by vec_id) - 1 as integer) as j, pos, x
  from emb where vec_id in (select vec_id from embeddings order by vec_id limit 4))"""


def variance(expression: str) -> str:
    v = f"coalesce(var_samp({expression}), case when count({expression}) = 1 then cast(0 as double) end)"
    return f"case when {v} > 1e6 then round({v}, 0) else round({v}, 8) end as variance"


def summary(metrics: str) -> str:
    return long_form("lineitem", metrics)


SUMMARY = (
    "count({f}) as n, round(avg({f}), 6) as mean, min({f}) as min, max({f}) as max, " + variance("{f}")
)

TRAIN = f"u < {double(TRAIN_SHARE)}"
DRAWN = with_uniform("items", KEY, SEED)

NB_MODEL = f"""{SCALED_ITEMS},
drawn as materialized (select * from {DRAWN}),
training as materialized (select * from drawn where {TRAIN}),
test as materialized (select * from drawn where not ({TRAIN})),
sums as materialized (
  select label, count(*) as n, {', '.join(f'sum({f}) as {f}' for f in SCALED)},
         {' + '.join(f'sum({f})' for f in SCALED)} as whole
  from training group by label),
model as materialized (
  select label,
         ln((n + 1.0::double) / ((select sum(n) from sums) + (select count(*) from sums))) as pi,
         {', '.join(f'ln(({f} + 1.0::double) / (whole + {len(SCALED)})) as {f}' for f in SCALED)}
  from sums)"""

NB_SCORED = f"""{NB_MODEL},
scored as materialized (
  select * from (
    select t.*, m.label as prediction,
           row_number() over (partition by {', '.join('t.' + k for k in KEY)}
             order by m.pi + {' + '.join(f't.{f} * m.{f}' for f in SCALED)} desc, m.label) as place
    from test t cross join model m)
  where place = 1)"""

TOKENS = "tokens as materialized (select doc_id, unnest(string_split(text, ' ')) as term from documents)"
TF = f"{TOKENS},\ntf as materialized (select doc_id, term, count(*) as tf from tokens group by doc_id, term)"


_LINED = r"""lined as materialized (
  select row_number() over (order by doc_id) - 1 as doc_id, rtrim(regexp_replace(text, '[\r\n]+', ' ', 'g')) as text from documents)"""
_LINED_TOKENS = f"{_LINED},\ntokens as materialized (select doc_id, unnest(string_split(text, ' ')) as term from lined)"


def idf_cte(source: str, key: str) -> str:
    return f"""idf as materialized (
  select {key}, df, case when df >= {MIN_DOC_FREQ}
           then ln(((select count(*) from documents) + 1.0::double) / (df + 1)) else 0 end as idf
  from (select {key}, count(*) as df from {source} group by {key}))"""


def _rotate(x: str, bits: int) -> str:
    return f"((({x}) << {bits}) | (({x}) >> {32 - bits})) & 4294967295"


def _mix_word(word: str) -> str:
    first = f"(({word}) * 3432918353::ubigint) % 4294967296::ubigint"
    return f"(({_rotate(first, 15)}) * 461845907::ubigint) % 4294967296::ubigint"


def _mix_hash(state: str, word: str) -> str:
    mixed = f"xor({state}, {word})"
    return f"(({_rotate(mixed, 13)}) * 5::ubigint + 3864292196::ubigint) % 4294967296::ubigint"


def _finish(state: str, shift: int, factor: int) -> str:
    mixed = f"xor({state}, ({state}) >> {shift})"
    return f"({mixed} * {factor}::ubigint) % 4294967296::ubigint" if factor else mixed


def hash_ctes(buckets: int) -> str:
    """Murmur3 (32 bits, seed 42) of each distinct term, byte by byte after the last
    whole word, as a signed number modulo the number of buckets."""
    byte = "cast('0x' || substr(h, cast(2 * ({i}) + 1 as bigint), 2) as ubigint)"

    def at(i: str) -> str:
        return byte.replace("{i}", i)

    word = f"{at('4 * w')} + 256 * {at('4 * w + 1')} + 65536 * {at('4 * w + 2')} + 16777216 * {at('4 * w + 3')}"
    tail = at("b")
    signed = f"case when {tail} > 127 then {tail} + 4294967040::ubigint else {tail} end"
    return f"""terms as materialized (
  select distinct term, hex(encode(term)) as h, cast(length(hex(encode(term))) // 2 as bigint) as size from tokens),
words as materialized (
  select term, size,
         list_concat(
           list_transform(range(0, size // 4), lambda w: cast({word} as ubigint)),
           list_transform(range(4 * (size // 4), size), lambda b: cast({signed} as ubigint))) as ks
  from terms),
mixed as materialized (
  select term, size, list_transform(ks, lambda k: {_mix_word('k')}) as ks from words),
states as materialized (
  select term, list_reduce(list_prepend(42::ubigint, ks), lambda s, k: {_mix_hash('s', 'k')}) as s, size from mixed),
f0 as materialized (select term, xor(s, size::ubigint) as s from states),
f1 as materialized (select term, {_finish('s', 16, 2246822507)} as s from f0),
f2 as materialized (select term, {_finish('s', 13, 3266489909)} as s from f1),
f3 as materialized (select term, {_finish('s', 16, 0)} as s from f2),
hashed as materialized (
  select term, cast(((cast(s as bigint) - case when s > 2147483647 then 4294967296 else 0 end)
                     % {buckets} + {buckets}) % {buckets} as integer) as bucket
  from f3)"""


def hashed_tf(buckets: int) -> str:
    return f"""{TOKENS},
{hash_ctes(buckets)},
tf as materialized (
  select doc_id, bucket, count(*) as tf from tokens join hashed using (term) group by doc_id, bucket)"""



def _als_rows() -> str:
    """Both sides' two factors: Cramer's rule for every owner in every half step."""
    start = with_uniform(with_uniform('(select distinct "user" from ratings)', ['"user"'], SEED, 0, name="p"), ['"user"'], SEED, 1, name="q")
    parts = [f'{RATINGS},\nu0 as materialized (select "user", p, q from {start})']

    def half(name: str, own: str, other: str, given: str) -> str:
        lam = double(LAMBDA)
        return f"""{name} as materialized (
  select {own}, (b1 * a22 - b2 * a12) / (a11 * a22 - a12 * a12) as p, (a11 * b2 - a12 * b1) / (a11 * a22 - a12 * a12) as q
  from (select {own}, sum(p * p) + {lam} * count(*) as a11, sum(p * q) as a12, sum(q * q) + {lam} * count(*) as a22,
               sum(rating * p) as b1, sum(rating * q) as b2
        from ratings join {given} using ({other}) group by {own}))"""

    for i in range(ALS_ROWS_ITERATIONS):
        parts.append(half(f"i{i + 1}", "item", '"user"', f"u{i}"))
        parts.append(half(f"u{i + 1}", '"user"', "item", f"i{i + 1}"))
    return ",\n".join(parts)


_PAIRED = """pairs as (
  select a.doc_id, b.doc_id as other_id from documents a join documents b on a.doc_id // 2 = b.doc_id),
dots as (
  select p.doc_id, sum(x.tf * y.tf) as dot from pairs p join tf x on x.doc_id = p.doc_id
  join tf y on y.doc_id = p.other_id and y.bucket = x.bucket group by p.doc_id),
squares as (select doc_id, sum(tf * tf) as sq from tf group by doc_id)"""


def _sparse_passes(passes: int) -> str:
    """Centres and assignments of the documents' hashed TF-IDF, pass by pass."""
    parts = [
        f"""{hashed_tf(BUCKETS)}, {idf_cte('tf', 'bucket')},
w as materialized (select doc_id, bucket, tf * idf as x from tf join idf using (bucket)),
own as materialized (select doc_id, sum(x * x) as sq from w group by doc_id),
firsts as (select doc_id, row_number() over (order by doc_id) - 1 as j from documents order by doc_id limit 4),
c0 as materialized (select j, bucket, x from w join firsts using (doc_id))"""
    ]
    for i in range(passes + 1):
        parts.append(
            f"""d{i} as materialized (
  select own.doc_id, firsts.j, own.sq + coalesce(s.sq, 0) - 2 * coalesce(p.dot, 0) as d
  from own cross join firsts left join (select j, sum(x * x) as sq from c{i} group by j) s on s.j = firsts.j
  left join (select w.doc_id, c.j, sum(w.x * c.x) as dot from w join c{i} c using (bucket) group by 1, 2) p
    on p.doc_id = own.doc_id and p.j = firsts.j),
a{i} as materialized (
  select doc_id, j, d from (select *, row_number() over (partition by doc_id order by d, j) as r from d{i}) where r = 1),
n{i} as materialized (select j, count(*) as n from a{i} group by j)"""
        )
        if i < passes:
            parts.append(
                f"""c{i + 1} as materialized (
  select a.j, bucket, sum(x) / max(n) as x from w join a{i} a using (doc_id) join n{i} n on n.j = a.j group by a.j, bucket
  union all select j, bucket, x from c{i} where j not in (select j from n{i}))"""
            )
    return ",\n".join(parts)


def _text_model(terms: str, key: str, attributes: str) -> str:
    """Naive Bayes of the documents' languages over ``terms`` (doc_id, key, tf)."""
    return f"""{terms},
drawn as materialized (select * from {with_uniform('documents', ['doc_id'], SEED)} where lang is not null),
training as materialized (select doc_id, lang from drawn where {TRAIN}),
test as materialized (select doc_id from drawn where not ({TRAIN})),
sums as materialized (select lang, {key}, sum(tf) as s from tf join training using (doc_id) group by lang, {key}),
wholes as (select lang, sum(s) as whole from sums group by lang),
sizes as (select lang, count(*) as n from training group by lang),
classes as materialized (
  select lang, ln((n + 1.0::double) / ((select sum(n) from sizes) + (select count(*) from sizes))) as pi,
         ln(1.0::double / (coalesce(whole, 0) + ({attributes}))) as absent,
         coalesce(whole, 0) + ({attributes}) as below
  from sizes left join wholes using (lang))"""


def _text_predictions(terms: str, key: str, attributes: str, known: str) -> str:
    return f"""with {_text_model(terms, key, attributes)},
counted as (select doc_id, sum(tf) as n from tf where {known} group by doc_id),
scored as (
  select t.doc_id, c.lang, c.pi + coalesce(k.n, 0) * c.absent + coalesce(h.s, 0) as score
  from test t cross join classes c left join counted k using (doc_id)
  left join (select tf.doc_id, s.lang, sum(tf.tf * ln(1.0::double + s.s)) as s from tf join sums s using ({key}) group by 1, 2) h
    on h.doc_id = t.doc_id and h.lang = c.lang)
select doc_id, lang as prediction
from (select *, row_number() over (partition by doc_id order by score desc, lang) as place from scored) where place = 1"""


def _first_round(k: int = 4) -> str:
    return f"""{ITEMS},
first_one as materialized (
  select {', '.join(F4)} from {DRAWN} order by u limit 1),
costed as materialized (
  select i.*, {distance('i', 'c')} as cost from items i cross join first_one c),
chosen as materialized (
  select * from {with_uniform('costed', KEY, SEED, 0)}
  where u < cast(2 as double) * cost * cast({k} as double) / (select sum(cost) from costed))"""


def _parallel_start(k: int = 4, rounds: int = 30) -> str:
    """k-means|| with two draws: candidates ``c``, their weights, and the centres ``s<rounds>``."""
    f4, star = ", ".join(F4), ", ".join(f"i.{c}" for c in [*KEY, *F4])
    share = f"cast(2 as double) * cost * cast({k} as double) / (select sum(cost) from costed2)"
    parts = [
        f"""{_first_round(k)},
costed2 as materialized (
  select {star}, least(i.cost, min({distance('i', 'c')})) as cost
  from costed i cross join (select distinct {f4} from chosen) c group by {star}, i.cost),
chosen2 as materialized (
  select * from {with_uniform('costed2', KEY, SEED, 1)} where u < {share}),
named as (
  select {f4}, min(round) as round
  from (select *, 0 as round from first_one union all select {f4}, 1 from chosen union all select {f4}, 2 from chosen2)
  group by {f4}),
c as materialized (select cast(row_number() over (order by round, {f4}) - 1 as integer) as j, {f4} from named),
{assign_cte('a', 'c')},
heavy as materialized (
  select c.j as nr, {', '.join('c.' + f for f in F4)}, count(*) as w from c join a on a.j = c.j
  group by c.j, {', '.join('c.' + f for f in F4)}),
p0 as materialized (select 0 as j, {f4} from heavy order by w desc, nr limit 1)"""
    ]
    for j in range(1, k):
        parts.append(f"""p{j} as materialized (
  select * from p{j - 1} union all
  (select {j} as j, {f4} from (
     select i.nr, {', '.join('i.' + f for f in F4)}, i.w * min({distance('i', 'c')}) as gain
     from heavy i cross join p{j - 1} c group by i.nr, i.w, {', '.join('i.' + f for f in F4)})
   order by gain desc, nr limit 1))""")
    parts.append(f"s0 as materialized (select * from p{k - 1})")
    means = ", ".join(f"sum({f} * w) / sum(w) as {f}" for f in F4)
    columns = ", ".join(f"coalesce(m.{f}, o.{f}) as {f}" for f in F4)
    for r in range(rounds):
        parts.append(f"""o{r} as materialized (
  select * from (
    select i.*, c.j, row_number() over (partition by i.nr order by {distance('i', 'c')}, c.j) as place
    from heavy i cross join s{r} c) where place = 1),
s{r + 1} as materialized (
  select o.j, {columns} from s{r} o left join (select j, {means} from o{r} group by j) m on m.j = o.j)""")
    return ",\n".join(parts)


def _trained(passes: int = 10, rounds: int = 30) -> str:
    """Lloyd passes from that start: assignments t0 and on."""
    parts = [_parallel_start(rounds=rounds), f"u0 as materialized (select * from s{rounds})"]
    for p in range(passes):
        parts.append(assign_cte(f"t{p}", f"u{p}"))
        parts.append(next_centers_cte(f"u{p + 1}", f"t{p}", f"u{p}"))
    return ",\n".join(parts)


def _components(k: int, rounds: int = 300) -> str:
    """Principal components of SCALED by power iteration with deflation: pc0 .. with v0 .. v3."""
    n = len(SCALED)
    cells = {(i, j): f"m{min(i, j)}{max(i, j)}" for i in range(n) for j in range(n)}
    parts = [
        f"{SCALED_ITEMS},\nmoments as materialized (select "
        + ", ".join(f"covar_samp({SCALED[i]}, {SCALED[j]}) as m{i}{j}" for i in range(n) for j in range(i, n))
        + " from items)"
    ]
    dot = lambda a, b: " + ".join(f"{a}v{i} * {b}v{i}" for i in range(n))
    for c in range(k):
        before = "".join(f" cross join l{b}" for b in range(c))

        def times(i: int, source: str, c: int = c) -> str:
            own = " + ".join(f"{cells[i, j]} * {source}v{j}" for j in range(n))
            less = "".join(f" - l{b}.lambda * l{b}.v{i} * ({dot(f'l{b}.', source)})" for b in range(c))
            return f"{own}{less}"

        start = ", ".join(f"cast({1 + i} as double) as v{i}" for i in range(n))
        step = ", ".join(f"{times(i, 'r.')} as w{i}" for i in range(n))
        length = "sqrt(" + " + ".join(f"w{i} * w{i}" for i in range(n)) + ")"
        parts.append(f"""r{c}(step, {', '.join(f'v{i}' for i in range(n))}) as (
  select 0, {start} union all
  select step + 1, {', '.join(f'w{i} / {length}' for i in range(n))}
  from (select step, {step} from r{c} r cross join moments{before} where step < {rounds})),
l{c} as materialized (
  select {', '.join(f'r.v{i}' for i in range(n))}, {' + '.join(f'r.v{i} * ({times(i, "r.")})' for i in range(n))} as lambda
  from r{c} r cross join moments{before} where step = {rounds}),
pc{c} as materialized (select {', '.join(f'v{i} * sign as v{i}' for i in range(n))} from (
  select *, case when greatest({', '.join(f'v{i}' for i in range(n))}) >= -least({', '.join(f'v{i}' for i in range(n))})
    then 1 else -1 end as sign from l{c}))""")
    return ",\n".join(parts)


def _projected() -> str:
    sums = [" + ".join(f"{f} * pc{c}.v{i}" for i, f in enumerate(SCALED)) for c in range(2)]
    return f"""with recursive {_components(2)}
select {KEY_LIST}, {', '.join(f'round({s}, 4) as pc{c}' for c, s in enumerate(sums))}
from items cross join pc0 cross join pc1"""


def _parse_events(columns: str) -> str:
    return f"select event_id, {columns} from events"


def _scaled_centers() -> list[list[float]]:
    return [[q, p / 1000.0, d * 100.0, t * 100.0] for q, p, d, t in CENTERS]


_ZERO = "cast(0 as double)"
_RATINGS_DRAWN = with_uniform("ratings", ['"user"', "item"], SEED)
_KNOWN_PAIRS = f"""with {RATINGS},
known as materialized (select * from {_RATINGS_DRAWN} where u < {double(ALS_SPARSE_SHARE)})
select "user", item from ratings
where "user" in (select "user" from known) and item in (select item from known)"""

ORACLES: dict[str, str] = {
    "parse_activity": _parse_events(
        f"case when event_type = 'click' then {_ZERO} else value end as smsin, "
        f"case when event_type = 'view' then value else {_ZERO} end as smsout, "
        "value as callin, cast(user_id as double) as callout"
    ),
    "parse_labelled": _parse_events(
        "case event_type when 'click' then cast(1 as double) when 'view' then cast(2 as double) "
        "else cast(3 as double) end as label, value as \"SepalLengthCm\", "
        "cast(user_id as double) as \"SepalWidthCm\", cast(1.5 as double) as \"PetalLengthCm\", "
        'value as "PetalWidthCm"'
    ),
    "parse_unlabelled": _parse_events(
        'value as "SepalLengthCm", cast(user_id as double) as "SepalWidthCm", '
        'cast(1.5 as double) as "PetalLengthCm", value as "PetalWidthCm"'
    ),
    "parse_ratings": f"""select {_ITEM_KEY}, cast(l_suppkey as integer) as "user",
  cast(l_partkey as integer) as item, l_quantity as rating from lineitem""",
    "parse_matrix": f"select {_ITEM_KEY}, {', '.join(f'{f} as c{i}' for i, f in enumerate(F4))} from lineitem",
    "parse_double_or_zero": _parse_events(f"case when event_type = 'click' then {_ZERO} else value end as number"),
    "label_encode": _parse_events(
        f"case {FLOWER_NAME} when 'Iris-setosa' then cast(1 as double) "
        "when 'Iris-versicolor' then cast(2 as double) else cast(3 as double) end as label"
    ),
    "drop_header": f"""select value from (
  select '{HEADER}' as value union all
  select event_type || ',' || cast(event_id as varchar) from events) where value <> '{HEADER}'""",
    "activity_file": "\nunion all\n".join(
        f"select '{name}' as attribute, count(*) as n, round(avg({x}), 6) as mean, min({x}) as min, max({x}) as max from events"
        for name, x in (
            ("smsin", f"(case when event_type = 'click' then {_ZERO} else value end)"),
            ("smsout", f"(case when event_type = 'view' then value else {_ZERO} end)"),
            ("callin", "value"),
            ("callout", "cast(user_id as double)"),
        )
    ),
    "matrix_statistics_file": "\nunion all\n".join(
        f"select '{i}' as attribute, {SUMMARY.replace('{f}', f)} from lineitem" for i, f in enumerate(F4)
    ),
    "col_summary_wide": "\nunion all\n".join(
        f"select 'c{c}' as attribute, {SUMMARY.replace('{f}', f'({F4[c % 4]} + {c})')} from lineitem" for c in range(18)
    ),
    "col_summary": summary(SUMMARY),
    "col_summary_selected": summary("count({f}) as n, round(avg({f}), 6) as mean, max({f}) as max"),
    "col_summary_array": f"""with {EMB}
select cast(pos as varchar) as attribute, count(x) as n, round(avg(x), 6) as mean, min(x) as min, max(x) as max,
  {variance('x')} from emb group by pos""",
    "col_summary_matrix": "\nunion all\n".join(
        f"select '{i}' as attribute, {SUMMARY.replace('{f}', f)} from lineitem" for i, f in enumerate(F4)
    ),
    "row_l2_norm": f"with {EMB} select vec_id, round(sqrt(sum(x * x)), 8) as norm from emb group by vec_id",
    "row_l2_norm_columns": f"""with {SCALED_ITEMS}
select {KEY_LIST}, round(sqrt({' + '.join(f'{f} * {f}' for f in SCALED)}), 8) as norm from items""",
    "sq_distance_array": f"""with {EMB}
select vec_id, round(sum((x - pos / 64.0::double) * (x - pos / 64.0::double)), 8) as sq_distance
from emb group by vec_id""",
    "split_train_test": f"""with {ITEMS} select {KEY_LIST}, {TRAIN} as in_train from {DRAWN}""",
    "split_train_test_sizes": f"""with {ITEMS}
select case when {TRAIN} then 'train' else 'test' end as side, count(*) as n from {DRAWN} group by 1""",
    "take_sample": f"with {ITEMS} select {KEY_LIST}, {', '.join(F4)} from {DRAWN} order by u limit 50",
    "take_sample_half": f"with {ITEMS} select {KEY_LIST} from {DRAWN} order by u limit (select count(*) // 2 from items)",
    "kmeans_assign": f"""with {ITEMS}, {centers_cte('c', CENTERS)}, {assign_cte('a', 'c')}
select {KEY_LIST}, cast(j as integer) as cluster, round(d, 4) as sq_distance from a""",
    "kmeans_assign_array": f"""with {EMB}, {EMB_CENTERS}, {emb_assign('a', 'ec')}
select vec_id, j as cluster, round(d, 8) as sq_distance from a""",
    "kmeans_cost_per_row": f"""with {ITEMS}, {centers_cte('c', CENTERS)}
select {', '.join('i.' + k for k in KEY)}, round(min({distance('i', 'c')}), 4) as cost
from items i cross join c group by {', '.join('i.' + k for k in KEY)}""",
    "kmeans_cost": f"""with {SCALED_ITEMS}, {centers_cte('c', _scaled_centers(), SCALED)},
{assign_cte('a', 'c', SCALED)}
select round(sum(d), 2) as cost from a""",
    "kmeans_step": f"""with {ITEMS}, {centers_cte('c', STEP_CENTERS)}, {assign_cte('a', 'c')},
{next_centers_cte('c1', 'a', 'c')},
sizes as (select c.j, count(a.j) as n from c left join a on a.j = c.j group by c.j),
both_ as (select c1.*, n, round(({distance('c1', 'c')}) / 1e6, 5) as moved_sq_m
  from c1 join sizes using (j) join c on c.j = c1.j)
{long_form('both_', 'cast(j as integer) as cluster, n, round({f}, 5) as center, moved_sq_m')}""",
    "kmeans_lloyd": f"""with {passes_ctes(PASSES)}
{long_form(f'c{PASSES}', 'cast(j as integer) as cluster, round({f}, 5) as center')}""",
    "kmeans_centers": f"""with {EMB}, {EMB_CENTERS}, {emb_assign('a', 'ec')}
select j as cluster, cast(pos as varchar) as attribute, round(avg(x), 7) as center
from a join emb using (vec_id) group by j, pos""",
    "kmeans_patterns": f"with {passes_ctes(PASSES)}\n{patterns(f'a{PASSES - 1}', ALL_METRICS)}",
    "kmeans_resumed": f"with {passes_ctes(PASSES)}\n{patterns(f'a{PASSES - 1}', ALL_METRICS)}",
    "kmeans_patterns_selected": f"""with {passes_ctes(PASSES)}
{patterns(f'a{PASSES - 1}', 'round(avg({f}), 5) as mean, max({f}) as max')}""",
    "kmeans_patterns_array": f"""with {EMB}, {EMB_CENTERS}, {emb_assign('a', 'ec')}
select j as cluster, cast(pos as varchar) as attribute, count(*) as n, round(avg(x), 7) as mean,
  round(min(x), 7) as min, round(max(x), 7) as max, round(stddev_samp(x), 7) as stddev
from a join emb using (vec_id) group by j, pos""",
    "kmeans_patterns_empty": f"""with {ITEMS}, {centers_cte('c', STEP_CENTERS)}, {assign_cte('a', 'c')},
every_ as (select c.j, count(a.j) as n, {', '.join(
        f'round(avg(a.{f}), 5) as {f}_mean, min(a.{f}) as {f}_min, max(a.{f}) as {f}_max, '
        f'round(stddev_samp(a.{f}), 5) as {f}_dev' for f in F4)}
  from c left join a on a.j = c.j group by c.j)
{long_form('every_', 'cast(j as integer) as cluster, n, {f}_mean as mean, {f}_min as min, {f}_max as max, {f}_dev as stddev')}""",
    "kmeans_converged": f"""with {passes_ctes(PASSES)}
select cast(n.j as integer) as cluster, round({distance('n', 'o')}, 2) as moved_sq,
  {distance('n', 'o')} <= 1e-8 as stopped
from c{PASSES} n join c{PASSES - 1} o on n.j = o.j""",
    "kmeans_run_info": f"""with {passes_ctes(PASSES)}
select cast({PASSES} as integer) as iterations,
  (select max({distance('n', 'o')}) <= 1e-8 from c{PASSES} n join c{PASSES - 1} o on n.j = o.j) as converged,
  round(sum(d) / 1e9, 4) as cost_bn from a{PASSES - 1}""",
    "kmeans_init_random": f"""with {ITEMS}
select distinct {', '.join(F4)} from (select * from {DRAWN} order by u limit 4)""",
    "kmeans_parallel_round": f"""with {_first_round()}
select {KEY_LIST}, {', '.join(F4)}, round(cost, 4) as cost from chosen""",
    "kmeans_candidate_weights": f"""with {_first_round()},
named as (
  select {', '.join(F4)}, min(round) as round
  from (select *, 0 as round from first_one union all select {', '.join(F4)}, 1 from chosen)
  group by {', '.join(F4)}),
c as materialized (
  select cast(row_number() over (order by round, {', '.join(F4)}) - 1 as integer) as j, {', '.join(F4)} from named),
{assign_cte('a', 'c')}
select c.j as candidate, {', '.join('c.' + f for f in F4)}, count(a.j) as n
from c left join a on a.j = c.j group by c.j, {', '.join('c.' + f for f in F4)}""",
    "kmeans_reduce_candidates": f"""with {_parallel_start()}
{long_form('s30', 'cast(j as integer) as cluster, round({f}, 5) as center')}""",
    "kmeans_train": f"with {_trained()}\n{patterns('t9', ALL_METRICS)}",
    "kmeans_train_check": long_form("lineitem", f"count(*) as n, {_ZERO} as largest_difference"),
    "kmeans_model_roundtrip": "select count(*) as n, cast(0 as bigint) as differing from lineitem",
    "nb_class_sums": f"""with {SCALED_ITEMS}
select label, count(*) as n, {', '.join(f'round(sum({f}), 3) as {f}' for f in SCALED)} from items group by label""",
    "nb_train": f"""with {NB_MODEL}
{long_form('model', 'label, round(pi, 10) as pi, round({f}, 10) as theta', SCALED)}""",
    "nb_labels": f"with {NB_MODEL} select distinct label from training",
    "nb_predict": f"with {NB_SCORED} select {KEY_LIST}, label, prediction from scored",
    "nb_accuracy": f"""with {NB_SCORED}
select count(*) as n, count(*) filter (where label = prediction) as correct,
  round(avg(case when label = prediction then cast(1 as double) else cast(0 as double) end), 10) as accuracy
from scored""",
    "nb_top100": f"""with {NB_SCORED}
select prediction, {KEY_LIST} from scored order by prediction, {KEY_LIST} limit 100""",
    "nb_model_roundtrip": f"""with {SCALED_ITEMS}
select count(*) as n, cast(0 as bigint) as differing from {DRAWN} where not ({TRAIN})""",
    "pca_covariance": f"""with {SCALED_ITEMS}
{' union all '.join(
        f"select '{a}' as attribute_a, '{b}' as attribute_b, round(covar_samp({a}, {b}), 6) as cov from items"
        for i, a in enumerate(SCALED) for b in SCALED[i:])}""",
    "pca_covariance_array": f"""with {EMB}
select cast(a.pos as varchar) as attribute_a, cast(b.pos as varchar) as attribute_b,
  round(covar_samp(a.x, b.x), 9) as cov
from emb a join emb b on a.vec_id = b.vec_id and a.pos <= b.pos group by a.pos, b.pos""",
    "pca_components": f"with recursive {_components(3)}\n" + " union all ".join(
        f"select {c} as component, '{f}' as attribute, round(v{i}, 6) as loading from pc{c}"
        for c in range(3) for i, f in enumerate(SCALED)
    ),
    "pca_project": _projected(),
    "pca_sample100": f"{_projected()} order by {KEY_LIST} limit 100",
    "pca_eigen_residual": "select cast(range as integer) as component, cast(0 as double) as residual, "
    "cast(1 as double) as length from range(5)",
    "pca_total_variance": f"""with {SCALED_ITEMS}
select round({' + '.join(f'var_samp({f})' for f in SCALED)}, 6) as variance from items""",
    "pca_rotation_norm": f"""with {SCALED_ITEMS}
select {KEY_LIST}, round(sqrt({' + '.join(f'{f} * {f}' for f in SCALED)}), 8) as norm from items""",
    "doc_tokens": """select doc_id, cast(unnest(range(len(parts))) as integer) as pos, unnest(parts) as token
from (select doc_id, string_split(text, ' ') as parts from documents)""",
    "doc_tokens_stripped": """select doc_id, cast(unnest(range(len(parts))) as integer) as pos, unnest(parts) as token
from (select doc_id, case when text <> '' and trim(text, ' ') = '' then cast([] as varchar[])
        else string_split(rtrim(text, ' '), ' ') end as parts from documents)""",
    "tf": f"with {TF} select doc_id, term, tf from tf",
    "tf_hashed": f"with {hashed_tf(BUCKETS)} select doc_id, bucket, tf from tf",
    "tf_hashed_default": f"with {hashed_tf(2**20)} select doc_id, bucket, tf from tf",
    "doc_freq": f"with {TF} select term, count(*) as df from tf group by term",
    "idf": f"""with {TF}
select term, df, round(ln(((select count(*) from documents) + 1.0::double) / (df + 1)), 10) as idf
from (select term, count(*) as df from tf group by term)""",
    "idf_min_doc_freq": f"with {TF}, {idf_cte('tf', 'term')} select term, df, round(idf, 10) as idf from idf",
    "tfidf": f"""with {TF}, {idf_cte('tf', 'term')}
select doc_id, term, tf, round(tf * idf, 9) as weight from tf join idf using (term)""",
    "tfidf_sample100": f"""with {TF}, {idf_cte('tf', 'term')}
select doc_id, term, tf, round(tf * idf, 9) as weight from tf join idf using (term)
order by doc_id, term limit 100""",
    "tfidf_hashed": f"""with {hashed_tf(BUCKETS)}, {idf_cte('tf', 'bucket')}
select doc_id, bucket, tf, round(tf * idf, 9) as weight from tf join idf using (bucket)""",
    "dot_sparse": f"""with {hashed_tf(BUCKETS)}, {_PAIRED}
select doc_id, other_id, cast(coalesce(dot, 0) as double) as dot from pairs left join dots using (doc_id)""",
    "distance_sparse": f"""with {hashed_tf(BUCKETS)}, {_PAIRED}
select p.doc_id, other_id, cast(coalesce(a.sq, 0) + coalesce(b.sq, 0) - 2 * coalesce(dot, 0) as double) as sq_distance
from pairs p left join dots using (doc_id) left join squares a on a.doc_id = p.doc_id left join squares b on b.doc_id = other_id""",
    "norm_sparse": f"""with {hashed_tf(BUCKETS)}
select doc_id, round(sqrt(cast(sum(tf * tf) as double)), 8) as norm from tf group by doc_id""",
    "col_summary_sparse": f"""with {hashed_tf(BUCKETS)},
every_ as (
  select cast(b as integer) as attribute, cast(coalesce(tf, 0) as double) as x
  from documents cross join range({BUCKETS}) r(b) left join tf on tf.doc_id = documents.doc_id and tf.bucket = b)
select attribute, count(*) as n, round(avg(x), 8) as mean, min(x) as min, max(x) as max, round(var_samp(x), 6) as variance
from every_ group by attribute""",
    "kmeans_tfidf": f"""with {_sparse_passes(PASSES)},
stored as (
  select a.j, bucket, count(*) as m, sum(x) as s, sum(x * x) as q, min(x) as low, max(x) as high
  from w join a{PASSES} a using (doc_id) group by a.j, bucket)
select cast(j as integer) as cluster, cast(bucket as integer) as attribute, n, round(s / n, 6) as mean,
  round(case when m < n then least(low, 0) else low end, 6) as min,
  round(case when m < n then greatest(high, 0) else high end, 6) as max,
  round(sqrt(greatest(q - s * s / n, 0) / nullif(n - 1, 0)), 6) as stddev
from stored join n{PASSES} using (j)""",
    "kmeans_tfidf_assign": f"""with {_sparse_passes(PASSES)}
select doc_id, cast(j as integer) as cluster, round(greatest(d, 0), 4) as sq_distance from a{PASSES}""",
    "nb_text_train": f"""with {_text_model(TF, 'term', '(select count(distinct term) from sums)')}
select lang as label, term, round(pi, 10) as pi, round(ln((s + 1.0::double) / below), 10) as theta from sums join classes using (lang)""",
    "nb_text_predict": _text_predictions(TF, 'term', '(select count(distinct term) from sums)', 'term in (select term from sums)'),
    "nb_text_hashed_predict": _text_predictions(hashed_tf(BUCKETS), 'bucket', str(BUCKETS), 'true'),
    "nb_score_file": f"""with flowers as materialized (
  select event_id, concat_ws(',', event_id, value, user_id, '1.5', value) as line, {FLOWER_NAME} as name,
         [cast(value as double), cast(user_id as double), 1.5::double, cast(value as double)] as x
  from events),
labelled as (select *, case name when 'Iris-setosa' then 1e0 when 'Iris-versicolor' then 2e0 else 3e0 end as label from flowers),
sums as materialized (
  select label, count(*) as n, [sum(x[1]), sum(x[2]), sum(x[3]), sum(x[4])] as s, sum(list_sum(x)) as whole from labelled group by label),
model as materialized (
  select label, ln((n + 1e0) / ((select sum(n) from sums) + (select count(*) from sums))) as pi,
         list_transform(s, lambda v: ln((v + 1e0) / (whole + 4))) as theta from sums)
select line as value, label as prediction
from (select line, m.label, row_number() over (partition by event_id order by m.pi + x[1] * m.theta[1] + x[2] * m.theta[2]
        + x[3] * m.theta[3] + x[4] * m.theta[4] desc, m.label) as place from flowers cross join model m)
where place = 1""",
    "document_lines_file": f"with {_LINED} select doc_id, text from lined",
    "tfidf_file": f"""with {hashed_tf(BUCKETS).replace(TOKENS, _LINED_TOKENS)}, {idf_cte('tf', 'bucket')}
select doc_id, bucket, tf, round(tf * idf, 9) as weight from tf join idf using (bucket)""",
    "als_score_file": 'select cast(l_suppkey as integer) as "user", cast(l_partkey as integer) as item from lineitem',
    "als_ratings": f'with {RATINGS} select "user", item, rating from ratings',
    "als_rows_train": f"""with {_als_rows()},
sides as (select 'user' as side, "user" as id, p, q from u{ALS_ROWS_ITERATIONS}
  union all select 'item', item, p, q from i{ALS_ROWS_ITERATIONS})
select side, id, cast(0 as integer) as position, round(p, 5) as value from sides
union all select side, id, cast(1 as integer), round(q, 5) from sides""",
    "als_rows_predict": f"""with {_als_rows()}
select "user", item, round(u.p * i.p + u.q * i.q, 4) as prediction
from ratings join u{ALS_ROWS_ITERATIONS} u using ("user") join i{ALS_ROWS_ITERATIONS} i using (item)""",
    "als_rows_equations": f'with {RATINGS} select distinct "user", true as solved from ratings',
    "als_predict_coverage": _KNOWN_PAIRS,
    "als_normal_equations": f'with {RATINGS} select distinct "user", true as solved from ratings',
    "als_predict_dot": f'with {RATINGS} select "user", item, true as same from ratings',
    "als_top100_pairs": f'with {RATINGS} select "user", item from ratings order by 1, 2 limit 100',
    "als_known_pairs": _KNOWN_PAIRS,
    "als_model_roundtrip": f"with {RATINGS} select count(*) as n, cast(0 as bigint) as differing from ratings",
}
