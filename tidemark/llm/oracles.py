"""Checks in DuckDB's SQL for the queries that it can express; it works with the texts of windows, not with hashes."""

from __future__ import annotations

from tidemark.llm.quality_rules import COVERAGE, FEWEST_WORDS, LINE_COVERAGE, MOST_REPEATED, WINDOW

_BLANK = r"\x20\x09-\x0D"
_DOCS = f"""docs as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^{_BLANK}]+') as ws
  from documents),
words as (select rid, unnest(ws) as word, generate_subscripts(ws, 1) as i from docs)"""


def _windows(n: int) -> str:
    return f"""(select rid, doc_id, i, array_to_string(ws[i:i + {n - 1}], ' ') as g
               from (select rid, doc_id, ws, unnest(range(1, len(ws) - {n - 2})) as i from docs))"""


def _covered(name: str, n: int, repeats: str) -> str:
    """Words and characters of each text in windows of n words that repeat."""
    return f"""{name} as (
  select rid, count(*) as words, cast(sum(length(word)) as bigint) as chars
  from words join (
    select distinct rid, unnest(range(i, i + {n})) as i
    from (select rid, i, {repeats} as k from {_windows(n)}) where k > 1) using (rid, i)
  group by rid)"""


SUBSTRING_DEDUP = f"""with {_DOCS},
gone as (
  select distinct rid, unnest(range(i, i + 20)) as i
  from (select rid, i, row_number() over (partition by g order by doc_id, rid, i) as k from {_windows(20)})
  where k > 1),
marked as (select rid, i, word, gone.i is not null as out from words left join gone using (rid, i)),
kept as (
  select rid, count(*) filter (out) as n_removed, string_agg(word, ' ' order by i) filter (not out) as text
  from marked group by rid)
select doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_removed, 0) as n_removed,
       sha256(coalesce(kept.text, '')) as kept_sha256
from docs left join kept using (rid)"""

_OVER = " or ".join(f"coalesce(c{n}.chars, 0) > cast({share} as double) * word_chars" for n, share in COVERAGE.items())

QUALITY_RULES = f"""with {_DOCS},
{_covered("base", WINDOW, "count(*) over (partition by rid, g)")},
{", ".join(_covered(f"c{n}", n, "row_number() over (partition by rid, g order by i)") for n in COVERAGE)},
counts as (select rid, cast(sum(length(word)) as bigint) as word_chars from words group by rid),
lines as (
  select rid, line, row_number() over (partition by rid, line order by i) as k
  from (select rid, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as i
        from docs)),
repeats as (
  select rid, count(*) as n, cast(sum(length(regexp_replace(line, '[{_BLANK}]', '', 'g'))) as bigint) as chars
  from lines where k > 1 and regexp_matches(line, '[^{_BLANK}]') group by rid),
joined as (
  select doc_id, cast(len(ws) as bigint) as n_words, coalesce(counts.word_chars, 0) as word_chars,
         cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         coalesce(repeats.n, 0) as n_dup_lines, coalesce(base.words, 0) as n_repeat_words,
         len(ws) < {FEWEST_WORDS} or 100 * coalesce(base.words, 0) > {MOST_REPEATED} * len(ws) as base_failed,
         {_OVER.replace("word_chars", "coalesce(counts.word_chars, 0)")}
           or coalesce(repeats.chars, 0) > cast({LINE_COVERAGE} as double) * coalesce(counts.word_chars, 0) as over,
         coalesce(repeats.chars, 0) as dup_line_chars,
         {", ".join(f"coalesce(c{n}.chars, 0) as dup_{n}gram_chars" for n in COVERAGE)}
  from docs left join counts using (rid) left join repeats using (rid)
       left join base using (rid) {" ".join(f"left join c{n} using (rid)" for n in COVERAGE)})
select * exclude (over), not base_failed and not over as kept from joined"""

# Base 32 writes five hexadecimal digits as four characters.
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_QUAD = " || ".join(f"'{_BASE32}'[1 + cast((v // {32**k}) % 32 as integer)]" for k in (3, 2, 1, 0))

WARC = f"""with payloads as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages),
rows as (select *, min(page_id) over (partition by hex, strlen(html)) as first from payloads)
select page_id, cast(strlen(html) as bigint) as payload_bytes,
       array_to_string(list_transform(
         list_transform(range(0, 40, 5), lambda p: cast('0x' || hex[p + 1:p + 5] as bigint)), lambda v: {_QUAD}), '')
         as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to
from rows"""

ORACLES = {"op1_substring_dedup": SUBSTRING_DEDUP, "op7_warc": WARC, "op9_quality_rules": QUALITY_RULES}
