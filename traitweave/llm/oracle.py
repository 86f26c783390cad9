"""The corpus queries as SQL, where SQL can express them at a fair cost."""

from __future__ import annotations

OP2 = r"""
with plain as (
    select doc_id, length(coalesce(text, '')) as size,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as plain
    from documents
), ranked as (
    select *, count(*) over (partition by plain) as group_size,
        first_value(doc_id) over (partition by plain order by size desc, doc_id) as keep_id
    from plain
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(plain) as text_sha256 from ranked
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP3 = rf"""
with split as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), items as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), windows as (
    select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as t
    from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as i
        from (select *, least(len(w), 13) as n from items where len(w) > 0))
), starts as (
    select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as t
    from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
        from split, (select distinct n from windows) where len(w) >= n)
), hits as (
    select doc_id, i, s.n, item_id from starts s join windows using (t)
), counted as (
    select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(i, i + n)) as place from hits) group by 1
), named as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
    from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by 1
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from split left join counted using (doc_id) left join named using (doc_id)
"""

OP4 = rf"""
with cut as (
    select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents
), lines as (
    select doc_id, i, parts[i] as line,
        translate(trim(parts[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') as key
    from (select doc_id, parts, unnest(range(1, len(parts) + 1)) as i from cut)
), common as (
    select key, max(doc_id) as keeper from lines where length(key) >= 20 group by 1 having count(distinct doc_id) >= 3
), marked as (
    select doc_id, i, line, keeper is not null and keeper <> doc_id as gone from lines left join common using (key)
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": OP2, "op3_benchmark_decontamination": OP3, "op4_line_dedup": OP4}
