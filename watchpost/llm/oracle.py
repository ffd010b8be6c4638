"""DuckDB statements for the registered queries that SQL can express."""

from __future__ import annotations

LOWER_ASCII = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACED = r"'[^\x20\x09-\x0D]+'"

ALPHANUMERIC = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

# Text of a page as lines: what is no text goes, block elements end a line, other elements go.
_TEXT = "coalesce(html, '')"
for _pattern, _by in (
    (r"(?is)<script\b[^<>]*>.*?</script\s*>", "' '"),
    (r"(?is)<style\b[^<>]*>.*?</style\s*>", "' '"),
    (r"(?s)<!--.*?-->", "' '"),
    (
        r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|"
        r"nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^<>]*>",
        "chr(10)",
    ),
    (r"<[^<>]*>", "''"),
    (r"[\t\x0B\f\r ]+", "' '"),
):
    _TEXT = f"regexp_replace({_TEXT}, '{_pattern}', {_by}, 'g')"

# Base32 of a digest: five hexadecimal digits are four letters.
BASE32 = """array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  ((cast('0x' || substr(sha1(payload), 5 * (i // 4) + 1, 5) as bigint) >> (15 - 5 * (i % 4))) & 31)::int + 1, 1)
  for i in range(0, 32)], '')"""


def _covered(width: int) -> str:
    """Words inside windows of this width that their text holds twice or more."""
    gram = " || chr(1) || ".join(f"w[i + {k}]" for k in range(width))
    return f"""
      select distinct doc_id, unnest(range(i, i + {width})) as i from (
        select *, count(*) over (partition by doc_id, gram) as found from (
          select doc_id, i, {gram} as gram
          from (select doc_id, w, unnest(range(1, len(w) - {width - 2})) as i from texts)))
      where found > 1"""



def _rounds_of_centroids(rounds: int = 10) -> str:
    """``c0`` has the first centroids, ``c{rounds}`` the last; each row (c, v)."""
    distance = "list_sum([(a.v[i] - {c}.v[i]) * (a.v[i] - {c}.v[i]) for i in range(1, 65)])::bigint"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} as materialized (
  select a.n, a.vec_id, a.v, min(struct_pack(d := {distance.format(c=f"c{r}")}, c := c{r}.c)) as best
  from vectors a, c{r} group by all
)""")
        if r < rounds:
            # The remainder of a negative number is negative; taken twice it floors the quotient.
            steps.append(f"""m{r} as (
  select best.c as c, generate_subscripts(v, 1) as i, unnest(v) as x from a{r}
), c{r + 1} as materialized (
  select c{r}.c, coalesce(any_value(t.v), any_value(c{r}.v)) as v from c{r} left join (
    select c, list(((s - ((s % n) + n) % n) // n)::bigint order by i) as v
    from (select c, i, sum(x)::bigint as s, count(*) as n from m{r} group by c, i) group by c
  ) t on t.c = c{r}.c group by c{r}.c
)""")
    return ",\n".join(steps)


ORACLE_SQL = {
    "op1_line_dedup": f"""
with lined as (
  select page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') as host,
    [trim(x) for x in string_split({_TEXT}, chr(10)) if trim(x) <> ''] as lines
  from pages
), totals as (select host, count(*) as total from lined where host is not null group by host having count(*) >= 4),
counts as (
  select host, line, count(*) as n from (
    select page_id, host, unnest(list_distinct(lines)) as line from lined where host is not null) group by all
), gone as (
  select host, list(line) as boilerplate from counts join totals using (host) where n * 10 > 3 * total group by host
), cut as (
  select page_id, lined.host, lines, [x for x in lines if not list_contains(coalesce(boilerplate, []), x)] as kept
  from lined left join gone on lined.host = gone.host
)
select page_id, host, len(lines) as n_lines, len(lines) - len(kept) as n_dropped, array_to_string(kept, chr(10)) as text
from cut
""",
    "op2_warc_roundtrip": f"""
with payloads as (select page_id, coalesce(html, '') as payload from pages)
select page_id, strlen(payload) as payload_bytes, {BASE32} as payload_digest,
  if(page_id = largest, 'response', 'revisit') as record_type, if(page_id = largest, null, largest) as refers_to
from (select *, max(page_id) over (partition by payload) as largest from payloads)
""",
    "op3_decontaminate": f"""
with texts as (select doc_id, regexp_extract_all({LOWER_ASCII}, {ALPHANUMERIC}) as w from documents),
items as (select item_id, regexp_extract_all({LOWER_ASCII}, {ALPHANUMERIC}) as w from benchmark),
windows as (
  select distinct item_id, least(10, len(w)) as size, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') as gram
  from (select *, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from items where len(w) > 0)
), sizes as (select distinct size from windows),
places as (
  select doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') as gram
  from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i from texts cross join sizes)
), found as (select doc_id, i, places.size, item_id from places join windows on places.gram = windows.gram and places.size = windows.size),
hits as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + size)) as j from found) group by 1),
listed as (
  select doc_id, count(distinct item_id) as n_items,
    array_to_string(list_sort(list_distinct(list(cast(item_id as varchar)))), ',') as ids
  from found group by 1
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from texts left join hits using (doc_id) left join listed using (doc_id)
""",
    "op8_repetition_rules": f"""
with texts as (select doc_id, text, regexp_extract_all(coalesce(text, ''), {SPACED}) as w from documents),
sizes as (
  select doc_id, text, w, len(w) as n_words, coalesce(list_sum([length(x) for x in w]), 0)::bigint as word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) as n_symbols
  from texts
), lines as (
  select doc_id, line, row_number() over (partition by doc_id, line) as nth from (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line from documents)
), dup_lines as (
  select doc_id, count(*) filter (nth > 1 and regexp_matches(line, {SPACED})) as n_dup_lines,
    coalesce(sum(length(line)) filter (nth > 1 and regexp_matches(line, {SPACED})), 0)::bigint as dup_line_chars,
    sum(length(line))::bigint as line_chars
  from lines group by 1
), covered as (
  {" union all ".join(f"select {width} as width, * from ({_covered(width)})" for width in (3, 5, 7, 10))}
), covers as (
  select doc_id, count(*) filter (width = 3) as n_repeat_words,
    {", ".join(f"coalesce(sum(length(w[i])) filter (width = {width}), 0)::bigint as dup_chars_{width}" for width in (5, 7, 10))}
  from covered join texts using (doc_id) group by 1
), measures as (
  select doc_id, n_words, word_chars, n_symbols, n_dup_lines, dup_line_chars, line_chars,
    coalesce(n_repeat_words, 0) as n_repeat_words,
    {", ".join(f"coalesce(dup_chars_{width}, 0) as dup_chars_{width}" for width in (5, 7, 10))}
  from sizes join dup_lines using (doc_id) left join covers using (doc_id)
)
select * exclude (line_chars), n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words or 100 * dup_line_chars > 30 * line_chars
    or 100 * dup_chars_5 > 40 * word_chars or 100 * dup_chars_7 > 35 * word_chars
    or 100 * dup_chars_10 > 30 * word_chars) as kept
from measures
""",
    "op5_quotation_links": r"""
with recursive messages as (select row_number() over () as id, * from conversations),
split_lines as (
  select id, conv_id, turn, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i
  from messages
), leveled as (
  select *, length(translate(regexp_extract(line, '^([> \t]*)', 1), ' ' || chr(9), '')) as level,
    regexp_replace(line, '^[> \t]*|[ \t\x0B\f\r]+$', '', 'g') as content
  from split_lines
), flagged as (
  select *, coalesce(lag(level) over w <> level, true) as new_run, coalesce(lag(content) over w = '', false) as after_blank,
    coalesce(lead(level) over w, 0) as next_level
  from leveled window w as (partition by id order by i)
), numbered as (
  select *, sum(new_run::int) over w as run, sum((new_run or after_blank)::int) over w as paragraph
  from flagged window w as (partition by id order by i)
), passages as (
  select conv_id, turn, level, string_agg(content, ' ' order by i) as passage, true as whole
  from numbered group by id, conv_id, turn, level, run
  union all
  select conv_id, turn, level, string_agg(content, ' ' order by i), true
  from numbered group by id, conv_id, turn, level, paragraph
  union all
  select conv_id, turn, level, content, false from numbered
), units as (
  select distinct conv_id, turn, level, passage from (
    select * replace (trim(regexp_replace(lower(passage), '[^\p{L}\p{N}]+', ' ', 'g')) as passage) from passages)
  where length(passage) >= 8 or whole and passage <> ''
), origins as (
  select conv_id, passage, min(turn) as origin from units where level = 0 group by all
), votes as (
  select u.conv_id, u.turn, u.level, o.origin, sum(length(u.passage)) as chars
  from units u join origins o on u.conv_id is not distinct from o.conv_id and u.passage = o.passage
  where u.level > 0 and o.origin < u.turn
  group by all
), links as (
  select conv_id, turn, first(origin order by level, chars desc, origin) as parent,
    array_to_string(list_sort(list_distinct(list(origin))), ',') as quoted
  from votes group by conv_id, turn
), above(conv_id, turn, thread, depth) as (
  select conv_id, turn, parent, 1 from links
  union all
  select a.conv_id, a.turn, l.parent, a.depth + 1
  from above a join links l on a.conv_id is not distinct from l.conv_id and a.thread = l.turn
), roots as (select conv_id, turn, arg_max(thread, depth) as thread, max(depth) as depth from above group by all),
placed as (
  select m.conv_id, m.turn, l.parent, coalesce(r.thread, m.turn) as thread, coalesce(r.depth, 0)::bigint as depth,
    coalesce(l.quoted, '') as quoted_turns
  from (select distinct conv_id, turn from messages) m
  left join links l on l.conv_id is not distinct from m.conv_id and l.turn is not distinct from m.turn
  left join roots r on r.conv_id is not distinct from m.conv_id and r.turn is not distinct from m.turn
), positions as (
  select *, row_number() over (partition by conv_id order by thread nulls first, turn nulls first) - 1 as position from placed
), own as (
  select id, string_agg(line, chr(10) order by i) as text from flagged
  where level = 0 and not (next_level > 0 and regexp_matches(line, '(?i)(wrote|schrieb|écrit|escribió).*:\s*$'))
  group by id
)
select m.conv_id, m.turn, m.role, p.parent as parent_turn, p.thread, p.depth, p.position, p.quoted_turns,
  regexp_replace(coalesce(own.text, ''), '^\n+|\n+$', '', 'g') as text
from messages m
join positions p on p.conv_id is not distinct from m.conv_id and p.turn is not distinct from m.turn
left join own on own.id = m.id
""",
    "op6_jaccard_join": f"""
with recursive texts as (
  select doc_id, regexp_extract_all({LOWER_ASCII}, {SPACED}) as w from documents
), sets as (
  select doc_id, case
    when len(w) >= 4 then list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]
                                         for i in range(1, len(w) - 2)])
    when len(w) > 0 then [array_to_string(w, ' ')]
    else [] end as s
  from texts
), items as (select doc_id, len(s) as n, unnest(s) as item from sets),
pairs as (
  select a.doc_id as x, b.doc_id as y, count(*) as common, any_value(a.n + b.n) as total
  from items a join items b on a.item = b.item and a.doc_id <> b.doc_id group by all
), links as (select x, y from pairs where 100 * common >= 85 * (total - common)),
reached(doc_id, root) as (
  select doc_id, doc_id from documents
  union select links.y, reached.root from reached join links on links.x = reached.doc_id
)
select doc_id, any_value(len(s)) as n_shingles, min(root) as component_id
from reached join sets using (doc_id) group by doc_id
""",
    "op13_centroid_clustering": f"""
with vectors as materialized (
  select row_number() over () as n, vec_id, [floor(1024 * x::double)::bigint for x in embedding] as v
  from embeddings
  where len(embedding) = 64 and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), c0 as materialized (
  select (row_number() over (order by h nulls last, v) - 1)::int as c, v
  from (select sha256('3:' || vec_id) as h, v from vectors order by h nulls last, v limit 8)
), {_rounds_of_centroids()},
sums as (select best.c as c, sum(best.d)::bigint as s from a10 group by 1)
select vec_id, best.c as cluster, best.d as distance, sums.s as cluster_inertia,
  (select sum(s)::bigint from sums) as inertia, sha256(array_to_string(c10.v, ',')) as centroid_sha256
from a10 join sums on sums.c = best.c join c10 on c10.c = best.c
""",
}
