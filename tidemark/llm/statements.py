"""DuckDB SQL for the queries that SQL can state."""

from __future__ import annotations

WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


OP3_SQL = r"""
with parts as (
  select doc_id, text, regexp_extract_all(text, '[^.!?\n]*[.!?\n]+[ \t\r\n]*|[^.!?\n]+') as s from documents
),
sentences as (
  select doc_id, i, s[i] as sentence, len(regexp_extract_all(s[i], '[^\x20\x09-\x0D]+')) as words
  from (select doc_id, s, unnest(range(1, len(s) + 1)) as i from parts)
),
spoken as (
  select *, row_number() over w as nth, sum(words) over w as upto,
    trim(sentence, ' ' || chr(9) || chr(10) || chr(13)) as said
  from sentences where words > 0 window w as (partition by doc_id order by i)
),
-- From every sentence, the first one by which 20 words are reached.
spans as (
  select a.doc_id, a.i as first, b.i as last, a.nth as nth_first, b.nth as nth_last
  from (select *, upto - words + 20 as wanted from spoken) a
    asof join spoken b on a.doc_id = b.doc_id and b.upto >= a.wanted
),
texts as (select doc_id, list(said order by nth) as said from spoken group by doc_id),
ranked as (
  select doc_id, first, last,
    row_number() over (partition by said[nth_first : nth_last] order by doc_id, first) as occurrence
  from spans join texts using (doc_id)
),
covered as (
  select distinct doc_id, unnest(range(first, last + 1)) as i from ranked where occurrence > 1
),
gone as (select doc_id, list(i) as removed, count(*) as n from covered group by doc_id)
select p.doc_id,
  case when n is null then text else array_to_string(
    list_transform(list_filter(range(1, len(s) + 1), lambda i: not list_contains(removed, i)), lambda i: s[i]), '') end as text,
  coalesce(len(s), 0) as n_sentences, coalesce(n, 0) as n_removed
from parts p left join gone g on p.doc_id = g.doc_id
"""


def crc32(text: str) -> str:
    """The unsigned crc32 of a VARCHAR's UTF-8, half a byte at a time."""

    def half(x: int) -> int:
        for _ in range(4):
            x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
        return x

    table = ", ".join(f"{half(i)}::bigint" for i in range(16))
    digits = f"hex(encode({text}))"
    halves = (
        f"list_transform(range(length({digits})), lambda i: "
        f"(strpos('0123456789ABCDEF', {digits}[i - i % 2 + 2 - i % 2]) - 1)::bigint)"
    )
    step = f"xor(c >> 4, ([{table}])[(xor(c, x) & 15) + 1])"
    return f"xor(list_reduce([4294967295::bigint] || {halves}, lambda c, x: {step}), 4294967295::bigint)"


OP11_SQL = rf"""
with recursive runs as (
  select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) as run from documents
),
lowered as (
  select doc_id, translate(run, {LOWER}) as run, count(*) as n from runs group by all
),
hashed as (select run, n, {crc32("coalesce(doc_id::varchar, '') || ':' || run")} as h from lowered where length(run) >= 7),
words as (
  select case when h % 31 = 0 then left(run, h % length(run)) || substr(run, h % length(run) + 2) else run end as word,
    sum(n)::bigint as n
  from hashed group by 1 having length(word) >= 7 and sum(n) >= 2
),
shorter as (
  select distinct word, i, left(word, i) || substr(word, i + 2) as rest
  from (select word, unnest(range(length(word))) as i from words)
),
pairs as (
  select a.word as a, b.word as b from shorter a join words b on a.rest = b.word
  union
  select b.word, a.word from shorter a join words b on a.rest = b.word
  union
  select a.word, b.word from shorter a join shorter b on a.rest = b.rest and a.i = b.i and a.word <> b.word
),
ranked as (
  select a as word, w.n, b as near, v.n as near_n, count(*) over (partition by a) as n_near,
    row_number() over (partition by a order by v.n desc, encode(b)) as nth
  from pairs join words w on a = w.word join words v on b = v.word
),
forms as (
  select word, n_near, case when near_n >= 10 * n then near end as form, case when near_n >= 10 * n then near_n end as form_n
  from ranked where nth = 1
),
paths as (
  select word, form as root from forms where form is not null
  union all
  select p.word, f.form from paths p join forms f on p.root = f.word where f.form is not null
),
roots as (
  select p.word, p.root from paths p left join forms f on p.root = f.word where f.form is null
)
select w.word, f.form, coalesce(r.root, w.word) as root, w.n, coalesce(f.n_near, 0)::bigint as n_near, f.form_n
from words w left join forms f on w.word = f.word left join roots r on w.word = r.word
"""

OP12_SQL = f"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as i
  from documents
),
keyed as (select doc_id, i, line, translate(trim(line, {WHITE}), {LOWER}) as key from lines),
often as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 40 group by key having count(distinct doc_id) >= 5
),
judged as (
  select k.doc_id, i, line, coalesce(k.doc_id <> keeper, false) as gone from keyed k left join often o on k.key = o.key
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from judged group by doc_id
"""


def _op13() -> str:
    def add(label: str, cost: str, edit: str) -> str:
        return f"lpad((left({label}, 9)::bigint + {cost})::varchar, 9, '0') || substr({label}, 10) || '{edit}'"

    # Labels: the least cost (9 digits) and audit by last speaker: none, system, user, assistant.
    stay = [add(f"acc[{s}]", "4", "D") for s in (1, 2, 3, 4)]
    extra = "x[3]::bigint"
    keeps = {
        2: [f"case when x[1] = 's' then {add('acc[1]', extra, 'K')} end"],
        3: [f"case when x[1] = 'u' then {add(f'acc[{s}]', extra, 'K')} end" for s in (1, 2, 4)],
        4: [f"case when x[1] = 'a' then {add('acc[3]', extra, 'K')} end"],
    }
    renames = {
        3: [add(f"acc[{s}]", f"(3 + {extra})", "R") for s in (1, 2, 4)],
        4: [add("acc[3]", f"(3 + {extra})", "R")],
    }
    taken = []
    for s in (1, 2, 3, 4):
        other = [f"case when x[2] = '0' then {e} end" for e in keeps.get(s, []) + renames.get(s, [])]
        taken.append(f"least({', '.join([stay[s - 1], *other])})" if other else stay[s - 1])
    users = ", ".join(add(f"acc[{s}]", "3", "I") for s in (1, 2, 4))
    step = f"""case x[1]
      when 'user' then [acc[1], acc[2], least(acc[3], {users}), acc[4]]
      when 'assistant' then [acc[1], acc[2], acc[3], least(acc[4], {add("acc[3]", "3", "I")})]
      else [{", ".join(taken)}] end"""
    h = crc32("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")
    return rf"""
with hashed as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {h} % 20 as h from conversations),
damaged as (
  select conv_id, turn, case h when 4 then 'user' else role end as role,
    case h when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case h when 0 then 0 when 3 then 2 else 1 end)) as copy
  from hashed
),
numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as nth,
    trim(text, {WHITE}) as words
  from damaged
),
judged as (
  select *, left(role, 1) as initial,
    case when words = '' then 'blank'
      when min(nth) over (partition by conv_id, role, text) < nth then 'duplicate'
      when right(words, 1) not in ('.', '!', '?') then 'truncated' end as fault,
    lag(left(role, 1)) over (partition by conv_id order by nth) as before
  from numbered
),
counted as (
  select conv_id,
    coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 'blank') as blank,
    count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal,
    [[repeat('0', 9), null, null, null]]
      || flatten(list([['user'], ['assistant'],
        [initial, case when fault in ('blank', 'duplicate') then '1' else '0' end,
         case when fault = 'truncated' then '3' else '0' end]] order by nth))
      || [['user'], ['assistant']] as steps
  from judged group by conv_id
),
solved as (
  select *, least(labels[1], labels[4]) as label
  from (select *, list_reduce(steps, lambda acc, x: {step}) as labels from counted)
),
edits as (
  select conv_id, label[10:][p] as edit, p,
    count(*) filter (label[10:][p] <> 'I') over (partition by conv_id order by p) as nth,
    count(*) filter (label[10:][p] <> 'D') over (partition by conv_id order by p) as kept
  from (select conv_id, label, unnest(range(1, length(label) - 8)) as p from solved)
),
placed as (
  select e.*, j.role, j.text,
    max(case when kept = 1 and edit = 'K' and initial = 's' then 1 else 0 end) over (partition by e.conv_id) as has_system
  from edits e left join judged j on e.conv_id = j.conv_id and e.nth = j.nth
),
repaired as (
  select conv_id, sha256(string_agg(
      case when edit = 'K' then role else case when (kept - has_system) % 2 = 1 then 'user' else 'assistant' end end
      || ':' || case when edit = 'I' then '' else text end, chr(10) order by p)) as sha
  from placed where edit <> 'D' group by conv_id
)
select c.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
  coalesce(left(label, 9)::bigint, 0) as cost, coalesce(substr(label, 10), '') as audit,
  coalesce(sha, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) c
  left join solved s on c.conv_id = s.conv_id left join repaired r on c.conv_id = r.conv_id
"""


OP13_SQL = _op13()
