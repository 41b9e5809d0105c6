"""DuckDB SQL of the queries that SQL can express."""

MIX_SQL = r"""
with w as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         md5(concat('mix:', doc_id::varchar)) as k
  from documents),
s as (select source, sum(size)::bigint as source_size from w group by source),
p as (select *, ((row_number() over (order by source nulls last) - 1) % 3 + 1)::bigint as weight from s),
r as (select *, sum(source_size) over ()::bigint as total,
        coalesce(sum(source_size * 3) over (o rows between unbounded preceding and 1 preceding), 0)::bigint as capped,
        (sum(weight) over () - coalesce(sum(weight) over (o rows between unbounded preceding and 1 preceding), 0))::bigint as weights,
        row_number() over o as place
      from p window o as (order by source_size / weight, source nulls last)),
f as (select place as first_free, total - capped as free_words, weights as by_weight from r
      where (total - capped) * weight <= source_size * 3 * weights order by place limit 1),
t as (select source, source_size,
        case when place < first_free then (source_size * 3)::double else (free_words * weight)::double / by_weight::double end as target
      from r, f),
c as (select w.doc_id, w.size, t.source_size, t.target,
        coalesce(sum(w.size) over (partition by w.source order by k, w.doc_id rows between unbounded preceding and 1 preceding), 0)::bigint as before_it
      from w join t on w.source is not distinct from t.source)
select doc_id, size, source_size, target,
  (case when source_size = 0 then 0 else (floor(target)::bigint // source_size) * size
     + greatest(0, least(size, floor(target)::bigint % source_size - before_it)) end)::bigint as taken
from c
"""
