"""DuckDB text for the queries whose results SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

SUBSTRING_DEDUP = f"""
with docs as (select doc_id, regexp_extract_all(coalesce(text, ''), {_BLANK}) as words from documents),
windows as (
  select doc_id, start, array_to_string(list_slice(words, start, start + 19), ' ') as run
  from (select *, unnest(range(1, len(words) - 18)) as start from docs where len(words) >= 20)),
later as (select doc_id, start from windows qualify row_number() over (partition by run order by doc_id, start) > 1),
gone as (select distinct doc_id, unnest(range(start, start + 20)) as place from later),
each as (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as place from docs),
kept as (
  select doc_id, string_agg(word, ' ' order by place) as text, count(*) as n
  from each anti join gone using (doc_id, place) group by doc_id)
select doc_id, len(words)::bigint as n_words, (len(words) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(text, '')) as kept_sha256
from docs left join kept using (doc_id)"""

DECONTAMINATION = f"""
with docs as (select doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) as words from documents),
items as (select item_id, regexp_extract_all({_LOWER}, {_ALNUM}) as words from benchmark),
windows as (
  select distinct item_id, list_slice(words, start, start + least(len(words), 13) - 1) as run
  from (select *, unnest(range(1, greatest(len(words) - 12, 1) + 1)) as start from items where len(words) > 0)),
sizes as (select distinct len(run) as size from windows),
places as (
  select doc_id, start, size, list_slice(words, start, start + size - 1) as run
  from (select *, unnest(range(1, len(words) - size + 2)) as start from docs, sizes where len(words) >= size)),
met as (select distinct doc_id, start, size, item_id from places join windows using (run)),
hits as (select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(start, start + size)) as place from met) group by 1),
named as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item_id::varchar as item from met) group by 1)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(words) as contaminated
from docs left join hits using (doc_id) left join named using (doc_id)"""

NGRAM_JACCARD = f"""
with recursive docs as (select doc_id, regexp_extract_all({_LOWER}, {_BLANK}) as words from documents),
grams as (
  select distinct doc_id, array_to_string(list_slice(words, start, start + 2), ' ') as gram
  from (select *, unnest(range(1, greatest(len(words) - 2, 1) + 1)) as start from docs where len(words) > 0)),
sizes as (select doc_id, count(*) as n from grams group by 1),
links as (
  select a.doc_id as a, b.doc_id as b
  from grams a join grams b using (gram) join sizes x on a.doc_id = x.doc_id join sizes y on b.doc_id = y.doc_id
  where a.doc_id <> b.doc_id group by all having 100 * count(*) >= 90 * (any_value(x.n) + any_value(y.n) - count(*))),
reach as (select a as doc_id, b as other from links union select reach.doc_id, links.b from reach join links on reach.other = links.a),
lowest as (select doc_id, min(other) as other from reach group by 1)
select doc_id, coalesce(n, 0)::bigint as n_shingles, least(doc_id, coalesce(other, doc_id)) as component_id
from docs left join sizes using (doc_id) left join lowest using (doc_id)"""



def _centroids(k: int = 16, rounds: int = 3, dims: int = 64) -> str:
    """Rounds of assignment and floored means, one after the other."""
    parts = [f"""kept as materialized (
  select row_number() over () as line, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v
  from embeddings where len(embedding) = {dims} and len(list_filter(embedding, lambda x: isfinite(x))) = {dims}),
c0 as materialized (
  select row_number() over (order by sha256('1:' || coalesce(vec_id::varchar, '')), v) - 1 as cluster, v as c from kept
  qualify cluster < {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} as materialized (
  select line, vec_id, v, cluster, distance from (
    select line, vec_id, v, cluster, list_sum(list_transform(range(1, {dims + 1}), lambda i: (v[i] - c[i]) * (v[i] - c[i]))) as distance
    from kept, c{r}) qualify row_number() over (partition by line order by distance, cluster) = 1)""")
        if r < rounds:
            parts.append(f"""m{r} as (
  select cluster, dim, sum(x)::bigint as total, count(*) as n
  from (select cluster, unnest(v) as x, unnest(range(1, {dims + 1})) as dim from a{r}) group by 1, 2),
c{r + 1} as materialized (
  select cluster, coalesce(n.c, o.c) as c from c{r} o left join (
    select cluster, list((total - ((total % n) + n) % n) // n order by dim) as c from m{r} group by 1) n using (cluster))""")
    return f"""with {", ".join(parts)}
select vec_id, cluster::int as cluster, distance::bigint as distance, (sum(distance) over (partition by cluster))::bigint as cluster_inertia,
  (sum(distance) over ())::bigint as inertia, sha256(array_to_string(c, ',')) as centroid_sha256
from a{rounds} join c{rounds} using (cluster)"""


CENTROIDS = _centroids()

BY_QUERY = {"op3_substring_dedup": SUBSTRING_DEDUP, "op8_decontamination": DECONTAMINATION, "op10_ngram_jaccard": NGRAM_JACCARD,
            "op13_centroid_threshold": CENTROIDS}
