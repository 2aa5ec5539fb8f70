"""Reference SQL for DuckDB of operators 1, 6 and 7, written from what they must return.

Windows are rows with their words joined by a space, and what they cover is counted place by
place; none of the hashes, anchors or indexes of the operators occur here.
"""

from __future__ import annotations

from tillsight.llm import decontamination, quality_rules, substring_dedup

SEPARATED = r"[^\x20\x09-\x0D]+"
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LAST = 2**63 - 1  # stands for a null id, which comes after all others


def windows(of: str, size: int | str, keep: str = "r") -> str:
    """(keep, pos, w): every window of `size` words of the rows `of`, which have words `ws`."""
    return f"""
        select {keep}, pos, array_to_string(list_slice(ws, pos, pos + {size} - 1), ' ') as w
        from (select {keep}, ws, unnest(range(1, len(ws) - {size} + 2)) as pos from {of})"""


def quality_sql() -> str:
    """Operator 1: base counts, measures, thresholds from binned quartiles, verdicts."""
    window, prior, spread = quality_rules.WINDOW, quality_rules.PRIOR, quality_rules.SPREAD
    names = ", ".join(quality_rules.MEASURES)
    limits, tests = [], []
    for name, (above, below) in quality_rules.MEASURES.items():
        here = f"filter (where measure = '{name}')"
        limits.append(f"max(q50 + {above} + {spread} * (q75 - q50)) {here} as {name}_most")
        tests.append(f"coalesce({name} <= {name}_most, true)")
        if below is not None:
            limits.append(f"max(q50 - {below} - {spread} * (q50 - q25)) {here} as {name}_least")
            tests.append(f"coalesce({name} >= {name}_least, true)")
    merged = lambda by: f"""
        select {by} measure, max(total) as total, {', '.join(f'min(value) filter (where upto * 100 >= total * {q}) as q{q}' for q in (25, 50, 75))}
        from (
            select {by} measure, value, sum(n) over (partition by {by} measure order by value) as upto, sum(n) over (partition by {by} measure) as total
            from (select {by} measure, value, count(*) as n from binned group by all)
        ) group by all"""  # noqa: E731
    shrunk = lambda rows, own, to: f"({rows} * {own} + {prior} * {to}) // ({rows} + {prior})"
    return rf"""
with texts as materialized (
    select row_number() over () as r, doc_id, lang, source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{SEPARATED}') as ws
    from documents
),
places as (select r, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as pos from texts),
nearby as (
    select r, count(*) filter (where word = one or word = two) as repeats
    from (select r, word, lag(word, 1) over (partition by r order by pos) as one, lag(word, 2) over (partition by r order by pos) as two from places)
    group by r
),
eights as ({windows('texts', window)}
),
covered as (
    select r, count(distinct place) as n
    from (select r, unnest(range(pos, pos + {window})) as place from (select r, pos, count(*) over (partition by r, w) as times from eights) where times > 1)
    group by r
),
lines as (
    select r, count(*) as n, count(distinct line) as different
    from (select r, unnest(string_split(text, chr(10))) as line from texts) where regexp_matches(line, '{SEPARATED}')
    group by r
),
counted as (
    select doc_id, lang, source, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
        (length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')))::bigint as capitals,
        coalesce(covered.n, 0)::bigint as n_repeat_words, coalesce(repeats, 0)::bigint as repeats,
        coalesce(lines.n, 0)::bigint as n_lines, coalesce(lines.n - different, 0)::bigint as n_dup_lines
    from texts left join nearby using (r) left join covered using (r) left join lines using (r)
),
measured as materialized (
    select doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        coalesce(word_chars * 100 // nullif(n_words, 0), 0) as word_length, coalesce(n_symbols * 1000 // nullif(n_words, 0), 0) as symbol_rate,
        coalesce(n_dup_lines * 1000 // nullif(n_lines, 0), 0) as dup_line_rate, coalesce(capitals * 1000 // nullif(word_chars, 0), 0) as capital_rate,
        coalesce(repeats * 1000 // nullif(n_words, 0), 0) as repeat_rate,
        n_words < {quality_rules.LEAST_WORDS} or 100 * n_repeat_words > {quality_rules.MOST_REPEATED} * n_words as base_failed
    from counted
),
long as (
    select lang, source, measure, x
    from (select lang, source, unnest([{', '.join(f"'{m}'" for m in quality_rules.MEASURES)}]) as measure, unnest([{names}]) as x from measured where n_words > 0)
),
binned as materialized (
    select lang, source, measure, case when x < 32 then x else (x >> (length(bin(x)) - 5)::int) << (length(bin(x)) - 5)::int end as value from long
),
of_source as ({merged('lang, source,')}
),
of_lang as ({merged('lang,')}
),
of_all as ({merged('')}
),
near as (
    select o.*, {', '.join(f"{shrunk('l.total', f'l.{q}', f'e.{q}')} as l{q}" for q in ('q25', 'q50', 'q75'))}
    from of_source o join of_lang l on l.lang is not distinct from o.lang and l.measure = o.measure join of_all e on e.measure = o.measure
),
chosen as (
    select lang, source, measure, {', '.join(f"{shrunk('total', q, f'l{q}')} as {q}" for q in ('q25', 'q50', 'q75'))} from near
),
limits as (select lang, source, {', '.join(limits)} from chosen group by lang, source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {names}, base_failed,
    case when base_failed then false else {' and '.join(tests)} end as kept
from measured m left join limits t on t.lang is not distinct from m.lang and t.source is not distinct from m.source
"""


def substrings_sql() -> str:
    """Operator 6: words removed because a window over them starts earlier as well."""
    size = substring_dedup.WINDOW
    return rf"""
with texts as materialized (
    select row_number() over () as r, doc_id, coalesce(doc_id, {LAST}) as id, regexp_extract_all(coalesce(text, ''), '{SEPARATED}') as ws from documents
),
spans as ({windows('texts', size, 'r, id')}
),
later as (
    select r, pos from (select r, id, pos, min((id, pos)) over (partition by w) as first from spans) where (id, pos) > first
),
gone as (select distinct r, unnest(range(pos, pos + {size})) as pos from later),
places as (select r, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as pos from texts),
left_ as (select r, string_agg(word, ' ' order by pos) as kept from places anti join gone using (r, pos) group by r),
removed as (select r, count(*) as n from gone group by r)
select doc_id, len(ws)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from texts left join left_ using (r) left join removed using (r)
"""


def benchmark_sql() -> str:
    """Operator 7: words inside windows of the benchmark, and the items that the windows are from."""
    size = decontamination.WINDOW
    split = f"regexp_extract_all(translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}'), '{WORDS}')"
    return rf"""
with texts as materialized (select row_number() over () as r, doc_id, {split} as ws from documents),
items as (select coalesce(item_id::varchar, '') as item, ws, least(len(ws), {size}) as size from (select item_id, {split} as ws from benchmark) where len(ws) > 0),
sought as materialized (select distinct item, size, w from ({windows('items', 'size', 'item, size')}
)),
sized as (select r, ws, size from texts, (select distinct size from sought)),
spans as ({windows('sized', 'size', 'r, size')}
),
found as materialized (select r, pos, size, item from spans join sought using (size, w)),
hit as (select r, count(distinct place) as n from (select r, unnest(range(pos, pos + size)) as place from (select distinct r, pos, size from found)) group by r),
named as (select r, count(*) as n, string_agg(item, ',' order by item) as items from (select distinct r, item from found) group by r)
select doc_id, len(ws)::bigint as n_words, coalesce(hit.n, 0)::bigint as n_hit, coalesce(named.n, 0)::bigint as n_items,
    sha256(coalesce(items, '')) as items_sha256, coalesce(hit.n, 0) > 0 as contaminated
from texts left join hit using (r) left join named using (r)
"""
