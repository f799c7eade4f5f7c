"""SQL twins of the registered queries of this subpackage, for DuckDB."""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

OP1 = f"""
with dw as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w
  from documents
), bw as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w
  from benchmark
), win as (
  select distinct item_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) g
  from (select item_id, w, least(13, len(w)) n from bw) x where n > 0
), grams as (
  select doc_id, n, unnest(range(1, len(w) - n + 2)) i, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) g
  from dw join (select distinct n from win) x on len(w) >= n
), met as (
  select doc_id, i, n, item_id from grams join win using (n, g)
), places as (
  select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + n)) p from met) x group by doc_id
), items as (
  select doc_id, count(*) n_items, string_agg(item_id, ',' order by item_id) ids
  from (select distinct doc_id, cast(item_id as varchar) item_id from met) x group by doc_id
)
select dw.doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from dw left join places using (doc_id) left join items using (doc_id)
"""

OP6 = f"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\\x20\\x09-\\x0D]+') w
  from documents
), s as (
  select doc_id, unnest(case when len(w) = 0 then [] when len(w) = 1 then [w[1]]
    else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end) shingle
  from w
), n as (
  select doc_id, count(*) n from s group by doc_id
), met as (
  select x.doc_id a, y.doc_id b, count(*) c from s x join s y on x.shingle = y.shingle and x.doc_id <> y.doc_id group by all
), link as (
  select a, b from met join n p on p.doc_id = a join n q on q.doc_id = b where 100 * c >= 80 * (p.n + q.n - c)
), reach(doc_id, other) as (
  select doc_id, doc_id from documents
  union
  select r.doc_id, b from reach r join link on a = other
), least as (
  select doc_id, min(other) component_id from reach group by doc_id
)
select d.doc_id, coalesce(n.n, 0) n_shingles, component_id, d.doc_id = component_id kept
from documents d join least using (doc_id) left join n using (doc_id)
"""

OP10 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) v
  from embeddings
  where vec_id is not null and embedding is not null and not list_contains(list_transform(embedding, lambda x: x is null or not isfinite(x)), true)
), pairs as (
  select q.vec_id query_id, c.vec_id, cast(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) as bigint) score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0
)
select query_id, cast(rank as integer) rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from pairs) x where rank <= 5
"""


def _clustering(k: int = 16, rounds: int = 3, width: int = 64, scale: int = 64, seed: int = 1) -> str:
    """Each round as a chain of named queries: distances to all centroids, the nearest, floors of the means."""
    parts = [
        f"""v as (
  select row_number() over () r, vec_id, list_transform(embedding, lambda x: cast(floor({scale} * cast(x as double)) as bigint)) v
  from embeddings
  where embedding is not null and len(embedding) = {width}
    and not list_contains(list_transform(embedding, lambda x: x is null or not isfinite(x)), true)
), c0 as (
  select row_number() over (order by sha256('{seed}:' || vec_id) nulls last, v) - 1 c, v from v
  order by sha256('{seed}:' || vec_id) nulls last, v limit {k}
)"""
    ]
    for n in range(rounds + 1):
        parts.append(f"""a{n} as (
  select r, vec_id, v, c, d from (
    select r, vec_id, x.v, c, d, row_number() over (partition by r order by d, c) p
    from (select v.r, v.vec_id, v.v, c.c, cast(list_sum(list_transform(range(1, {width} + 1), lambda i: (v.v[i] - c.v[i]) * (v.v[i] - c.v[i]))) as bigint) d
      from v cross join c{n} c) x
  ) y where p = 1
)""")
        if n < rounds:
            parts.append(f"""m{n} as (
  select c, i, cast(sum(x) as bigint) s, count(*) n
  from (select c, unnest(v) x, unnest(range(1, {width} + 1)) i from a{n}) z group by c, i
), c{n + 1} as (
  select c0.c, coalesce(m.v, c0.v) v from c{n} c0
  left join (select c, list((s - ((s % n) + n) % n) // n order by i) v from m{n} group by c) m on m.c = c0.c
)""")
    last = f"a{rounds}"
    return "with " + ", ".join(parts) + f"""
select vec_id, cast(a.c as integer) as "cluster", d as distance, cast(sum(d) over (partition by a.c) as bigint) as cluster_inertia,
  cast(sum(d) over () as bigint) as inertia, sha256(array_to_string(list_transform(f.v, lambda x: cast(x as varchar)), ',')) as centroid_sha256
from {last} a join c{rounds} f on f.c = a.c
"""


OP12 = """
with h as (
  select coalesce(text, '') t, length(coalesce(text, '')) n, doc_id, sha256('1:' || coalesce(cast(doc_id as varchar), '')) h from documents
), u as (
  select *, cast('0x' || substr(h, 1, 8) as ubigint) h1, cast('0x' || substr(h, 9, 8) as ubigint) h2,
    cast('0x' || substr(h, 17, 8) as ubigint) h3, cast('0x' || substr(h, 25, 8) as ubigint) h4
  from h
), f as (
  select doc_id, t, n, cast(least(h1 % (n + 1), h2 % (n + 1)) as bigint) a, cast(greatest(h1 % (n + 1), h2 % (n + 1)) as bigint) b,
    case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
      when h4 % 100 < 20 then 'spm' else 'psm' end form
  from u
), o as (
  select *, case form when 'plain' then t
    when 'psm' then '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
    else '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) end o
  from f
), p as (
  select *, strpos(o, '<P>') p, strpos(o, '<S>') s, strpos(o, '<M>') m from o
)
select doc_id, n, form, case when form <> 'plain' then a end prefix_chars, case when form <> 'plain' then b - a end middle_chars,
  sha256(o) output_sha256,
  sha256(case form when 'plain' then o
    when 'psm' then substr(o, 4, s - 4) || substr(o, m + 3) || substr(o, s + 3, m - s - 3)
    else substr(o, p + 3, m - p - 3) || substr(o, m + 3) || substr(o, 4, p - 4) end) restored_sha256
from p
"""

SQL = {"op11_centroid_clustering": _clustering(), "op12_fill_in_middle": OP12, "op10_exact_top_k": OP10, "op1_decontamination": OP1, "op6_minhash_near_dedup": OP6}
