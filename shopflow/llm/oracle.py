"""DuckDB SQL for the operators that SQL can express: the licence scan, the
URL rules stay with their model, and exact counts of the decontamination."""

from shopflow.llm.licenses import PERCENT, PHRASES, TEMPLATES

_WORDS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = f"translate(coalesce({{0}}, ''), '{_UPPER}', '{_LOWER}')"


def _starts(phrase: str) -> str:
    return "(" + " and ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(phrase.split())) + ")"


_LICENSES = f"""
with folded as (
  select row_number() over () as r, doc_id, {_FOLD.format('text')} as t from documents
), worded as (
  select r, doc_id, t, {_WORDS.format('t')} as w from folded
), placed as (
  select r, doc_id, t, len(w) as n_words,
         list_filter(range(1, len(w) + 1), lambda i: {' or '.join(_starts(p) for p, _ in PHRASES)}) as p,
         list_filter([{', '.join(f"case when len(list_filter(range(1, len(w) + 1), lambda i: {_starts(p)})) > 0 then '{name}' end" for p, name in PHRASES)}],
                     lambda x: x is not null) as base
  from worded
), templates(label, words) as (
  values {', '.join(f"('{label}', {sorted(set(t.split()))})" for label, t in TEMPLATES)}
), blocks as (
  select r, unnest(list_distinct(list_concat(string_split(t, chr(10)), regexp_split_to_array(t, '\n[ \t\r]*\n')))) as b from folded
), sets as (
  select r, list_distinct({_WORDS.format('b')}) as s from blocks
), found as (
  select r, list_distinct(list(label)) as more, max(len(list_intersect(s, words)) / len(words)) as best
  from sets, templates where 100 * len(list_intersect(s, words)) >= {PERCENT} * len(words) group by r
)
select doc_id, n_words, len(p) as n_base, list_min(p) - 1 as first_word, list_max(p) - 1 as last_word,
       array_to_string(list_sort(base), ',') as base_labels,
       array_to_string(list_sort(list_distinct(list_concat(base, coalesce(more, [])))), ',') as labels,
       case when len(p) > 0 then 1.0::double else coalesce(best, 0.0)::double end as score
from placed left join found using (r)
"""

_OVERLAP = f"""
with docs as (
  select row_number() over () as r, doc_id, {_WORDS.format(_FOLD.format('text'))} as w from documents
), items as (
  select cast(item_id as varchar) as item, {_WORDS.format(_FOLD.format('text'))} as w from benchmark
), patterns as (
  select item, least(13, len(w)) as m, unnest(range(1, len(w) - least(13, len(w)) + 2)) as i, w from items where len(w) > 0
), pats as (
  select distinct item, m, array_to_string(w[i:i + m - 1], ' ') as p from patterns
), sizes as (
  select distinct m from pats
), places as (
  select r, m, w, unnest(range(1, len(w) - m + 2)) as i from docs, sizes where len(w) >= m
), hits as (
  select r, i, places.m, item from places join pats on pats.m = places.m and array_to_string(w[i:i + places.m - 1], ' ') = p
), counted as (
  select r, count(distinct j) as n_hit from (select r, unnest(range(i, i + m)) as j from hits) group by r
), owners as (
  select r, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from hits group by r
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from docs left join counted using (r) left join owners using (r)
"""

_WARC = """
with rows as (
  select page_id, coalesce(html, '') as h from pages
), hashed as (
  select page_id, cast(strlen(h) as bigint) as payload_bytes, sha1(h) as payload_digest from rows
), marked as (
  select *, max(page_id) over (partition by payload_digest) as newest from hashed
)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 1000 and page_id is distinct from newest then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and page_id is distinct from newest then newest end as refers_to
from marked
"""

_SHINGLES = rf"""
with docs as (
  select row_number() over () as r, doc_id, regexp_extract_all({_FOLD.format('text')}, '[^\x20\x09-\x0D]+') as w from documents
), shingled as (
  select r, doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
         else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as s from docs
), classes as (
  select min(r) as c, list_sort(s) as s, len(list_sort(s)) as n, min(doc_id) as low from shingled group by list_sort(s)
), posted as (
  select c, n, unnest(s) as x from classes
), shared as (
  select a.c as a, b.c as b, count(*) as k, any_value(a.n) as na, any_value(b.n) as nb
  from posted a join posted b on a.x = b.x and a.c < b.c and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) group by a.c, b.c
), links as (
  select a, b from shared where 100 * k >= 80 * (na + nb - k)
), linked as (
  select a, b from links union all select b, a from links
), reach as (
  with recursive walk(a, b) as (select c, c from classes union select walk.a, linked.b from walk join linked on walk.b = linked.a)
  select a, b from walk
), roots as (
  select reach.a as c, min(classes.low) as low from reach join classes on classes.c = reach.b group by reach.a
)
select doc_id, cast(len(shingled.s) as bigint) as n_shingles,
       case when len(shingled.s) = 0 then doc_id else roots.low end as component_id,
       doc_id = case when len(shingled.s) = 0 then doc_id else roots.low end as kept
from shingled join classes on classes.s = list_sort(shingled.s) join roots on roots.c = classes.c
"""

_VECTORS = """
with vecs as (
  select row_number() over () as r, vec_id, embedding::double[] as e from embeddings
), usable as (
  select r, vec_id, e from vecs
  where e is not null and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0
), links as (
  select a.r as a, b.r as b from usable a join usable b on a.r <> b.r and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.9
), reach as (
  with recursive walk(a, b) as (select r, r from vecs union select walk.a, links.b from walk join links on walk.b = links.a)
  select a, b from walk
), roots as (
  select reach.a as r, min(vecs.vec_id) as low from reach join vecs on vecs.r = reach.b group by reach.a
), counted as (
  select a as r, count(*) as n from links group by a
)
select vec_id, coalesce(n, 0) as n_links, low as component_id, vec_id = low as kept
from vecs join roots using (r) left join counted using (r)
"""

_LINES = f"""
with docs as (
  select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents
), lines as (
  select r, doc_id, unnest(l) as line, generate_subscripts(l, 1) as pos from docs
), keyed as (
  select *, translate(trim(line, chr(9) || chr(11) || chr(12) || chr(13) || ' '), '{_UPPER}', '{_LOWER}') as k from lines
), held as (
  select k, min(doc_id) as low from keyed where length(k) >= 10 group by k having count(distinct r) >= 2
), judged as (
  select r, doc_id, pos, line, held.k is not null and doc_id is distinct from low as gone from keyed left join held using (k)
)
select any_value(doc_id) as doc_id, count(*) as n_lines, cast(count(*) filter (where gone) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from judged group by r
"""

_ROUNDS, _K = 5, 40


def _centroids() -> str:
    """Lloyd's rounds, one pair of materialised tables each."""
    near = """(select r, arg_min(cluster, struct_pack(d := d, c := cluster)) as cluster, min(d) as d
      from (select r, cluster, list_sum(list_transform(list_zip(vecs.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as d
            from vecs, {0} as c) group by r)"""
    parts = ["""vecs as materialized (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda v: cast(floor(256 * v::double) as bigint)) as x from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0
)""", f"""c0 as materialized (
  select row_number() over (order by sha256('2:' || vec_id) nulls last, x) - 1 as cluster, x from vecs
  order by sha256('2:' || vec_id) nulls last, x limit {_K}
)"""]
    for k in range(_ROUNDS):
        parts.append(f"a{k} as materialized {near.format(f'c{k}')}")
        parts.append(f"""c{k + 1} as materialized (
  select cluster, coalesce(moved.x, c{k}.x) as x from c{k} left join (
    select cluster, list(v order by i) as x from (
      select cluster, i, (sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) as v
      from (select cluster, unnest(x) as v, generate_subscripts(x, 1) as i from a{k} join vecs using (r)) group by cluster, i)
    group by cluster) as moved using (cluster)
)""")
    parts.append(f"last as materialized {near.format(f'c{_ROUNDS}')}")
    return f"""with {', '.join(parts)}
select vec_id, cast(cluster as int) as cluster, cast(d as bigint) as distance,
       cast(sum(d) over (partition by cluster) as bigint) as cluster_inertia, cast(sum(d) over () as bigint) as inertia,
       sha256(array_to_string(c.x, ',')) as centroid_sha256
from last join vecs using (r) join c{_ROUNDS} as c using (cluster)
"""


SQL: dict[str, str] = {
    "op3_license_scan": _LICENSES,
    "op4_warc_captures": _WARC,
    "op7_itq_hamming_dedup": _VECTORS,
    "op8_circulant_minhash": _SHINGLES,
    "op9_benchmark_decontamination": _OVERLAP,
    "op12_line_dedup": _LINES,
    "op13_laesa_centroids": _centroids(),
}
