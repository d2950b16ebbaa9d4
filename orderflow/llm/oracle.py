"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from orderflow.llm.licenses import COVER, DRIFT, GRAM, NOTICES, PHRASES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _licenses() -> str:
    """Every place of a template's gram by comparing words, no hashes."""
    known = ", ".join(
        f"({n}, '{label}', {n < len(PHRASES)}, {2 if n < len(PHRASES) else GRAM}, '{text}')"
        for n, (label, text) in enumerate((*PHRASES, *NOTICES))
    )
    return f"""
with d as (
  select row_number() over () as r, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') as w
  from documents),
t as (select *, string_split(words, ' ') as tw from (values {known}) v(n, label, phrase, k, words)),
tg as (
  select n, label, phrase, k, len(tw) - k + 1 as grams, unnest(range(1, len(tw) - k + 2)) as off,
    tw from t),
g as (select r, doc_id, w, unnest(range(1, len(w))) as pos from d),
hit as (
  select g.r, tg.n, tg.label, tg.phrase, tg.k, tg.grams, tg.off, g.pos, g.pos - tg.off as diagonal
  from g join tg on g.w[g.pos] = tg.tw[tg.off] and g.w[g.pos + 1] = tg.tw[tg.off + 1]
  where tg.k = 2 or g.w[g.pos + 2] = tg.tw[tg.off + 2]),
diag as (select distinct r, n, phrase, diagonal from hit),
cut as (
  select *, case when phrase or diagonal - lag(diagonal) over p > {DRIFT}
      or lag(diagonal) over p is null then 1 else 0 end as apart
  from diag window p as (partition by r, n order by diagonal)),
run as (select *, sum(apart) over (partition by r, n order by diagonal) as span from cut),
spans as (
  select hit.r, hit.label, hit.phrase, min(pos) - 1 as start,
    count(distinct off) / cast(greatest(any_value(grams), max(pos) - min(pos) + 1) as double) as score
  from hit join run on hit.r = run.r and hit.n = run.n and hit.diagonal = run.diagonal
  group by hit.r, hit.n, hit.label, hit.phrase, run.span
  having score >= case when hit.phrase then 1.0 else {COVER} end),
per as (
  select r, count(*) filter (phrase) as n_base, min(start) filter (phrase) as first_word,
    max(start) filter (phrase) as last_word,
    string_agg(distinct label, ',' order by label) filter (phrase) as base_labels,
    string_agg(distinct label, ',' order by label) as labels, max(score) as score
  from spans group by r)
select doc_id, len(w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
  coalesce(score, 0.0) as score
from d left join per on d.r = per.r"""


_SPACE = "\\x20\\x09-\\x0D"


def _repeats() -> str:
    """Windows by their words, no automata."""
    return f"""
with d as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^{_SPACE}]+') as w from documents),
win as (
  select r, doc_id, i, array_to_string(w[i:i + 12], ' ') as g
  from (select *, unnest(range(1, len(w) - 11)) as i from d)),
early as (select g, min(doc_id) as first from win group by g),
gone as (
  select distinct r, unnest(range(i, i + 13)) as p from win join early using (g)
  where first < doc_id),
per as (select r, list(p) as p from gone group by r)
select doc_id, len(w) as n_words, coalesce(len(p), 0) as n_removed,
  sha256(array_to_string(list_filter(w, lambda x, k: not list_contains(coalesce(p, []), k)), ' '))
    as kept_sha256
from d left join per on d.r = per.r"""


def _chat() -> str:
    """Digests of the turns themselves; the template only adds to the length."""
    marked = lambda x: f"(2 * length({x}) - length(regexp_replace({x}, '[\\\\<\\[]', '', 'g')))"
    return f"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -1, t, r, '</s>[INST] ok [/INST]' from (values (0, 'user'), (1, 'assistant')) v(t, r)),
per as (
  select conv_id, count(*) as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as said,
    coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '') as loss,
    sum({marked('role')} + {marked('text')} + 20) as formatted_chars
  from c group by conv_id)
select conv_id, n_turns, sha256(said) as turns_sha256, length(loss) as loss_chars,
  sha256(loss) as loss_sha256, cast(formatted_chars as bigint) as formatted_chars
from per"""


def _warc() -> str:
    """Five hexadecimal digits are four of base 32."""
    return """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
    sha1(coalesce(html, '')) as hex, min(page_id) over (partition by coalesce(html, '')) as first
  from pages)
select page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((cast('0x' || substr(hex, 1 + 5 * (k // 4), 5) as bigint) >> (15 - 5 * (k % 4))) & 31), 1)),
    '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to
from p"""


def _crc32(text: str) -> str:
    """Of ASCII text, bit by bit: a character comes in, eight bits go out."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [cast(ord(c) as bigint), -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = """lambda a, x: case when x >= 0 then xor(a, x)
      when a % 2 = 1 then xor(a >> 1, 3988292384) else a >> 1 end"""
    return f"xor(list_reduce({steps}, {step}, cast(4294967295 as bigint)), cast(4294967295 as bigint))"


def _repair() -> str:
    """Cheapest edits from the last row backwards: per state the least pair of cost
    and letters. Then the letters alone tell what becomes of each row."""
    never = 1_000_000
    keeps = ({"s": 2, "u": 3}, {"u": 3}, {"a": 4}, {"u": 3})  # state after a kept row
    follows = (3, 3, 4, 3)  # after the role that fits; states are 1 to 4

    def least(*pairs: tuple[str, str]) -> str:
        return "list_min([" + ", ".join(f"{{'c': cast({c} as bigint), 's': {s}}}" for c, s in pairs) + "])"

    own = []
    for state in range(4):
        ways = [(f"a[{state + 1}].c + 2", f"'D' || a[{state + 1}].s")]
        to = follows[state]
        ways.append((f"case when x.gone then {never} else a[{to}].c + 1 + x.stays end", f"'R' || a[{to}].s"))
        for initial, to in keeps[state].items():
            cost = f"case when x.gone or x.initial <> '{initial}' then {never} else a[{to}].c + x.stays end"
            ways.append((cost, f"'K' || a[{to}].s"))
        own.append(least(*ways))
    insert = lambda b, way: least((f"{b}.c", f"{b}.s"), (f"{way}.c + 5", f"'I' || {way}.s"))
    before = f"[{', '.join(own)}]"
    middle = f"list_transform([{before}], lambda b: [b[1], b[2], {insert('b[3]', 'b[4]')}, {insert('b[4]', 'b[3]')}])[1]"
    after = f"list_transform([{middle}], lambda b: [{insert('b[1]', 'b[3]')}, {insert('b[2]', 'b[3]')}, b[3], b[4]])[1]"
    ends = "[" + ", ".join(f"{{'c': cast({c} as bigint), 's': '{s}'}}" for c, s in ((0, ""), (10, "II"), (5, "I"), (0, ""))) + "]"
    return f"""
with raw as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    {_crc32("coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')")} % 20
      as fault
  from conversations),
hurt as (
  select conv_id, turn, case when fault = 4 then 'user' else role end as role,
    case fault when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
    unnest(case when fault = 3 then [1, 2] else [1] end) as copy
  from raw where fault <> 0),
numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as k,
    row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 as again,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body,
    substr(role, 1, 1) as initial
  from hurt),
judged as (
  select *, body = '' as blank, again and body <> '' as duplicate,
    body <> '' and not again and right(body, 1) not in ('.', '!', '?') as truncated,
    coalesce(lag(initial) over (partition by conv_id order by k) || initial
      not in ('su', 'ua', 'au'), false) as illegal
  from numbered),
per as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (blank) as blank, count(*) filter (duplicate) as duplicate,
    count(*) filter (truncated) as truncated, count(*) filter (illegal) as illegal,
    list_reduce(list({{'gone': blank or duplicate, 'stays': case when truncated then 5 else 0 end,
      'initial': initial}} order by k desc), lambda a, x: {after}, {ends})[1] as best
  from judged group by conv_id),
letters as (
  select conv_id, best.s as audit, unnest(range(1, length(best.s) + 1)) as spot from per),
edits as (
  select conv_id, spot, substr(audit, spot, 1) as edit,
    sum(case when substr(audit, spot, 1) <> 'I' then 1 else 0 end)
      over (partition by conv_id order by spot) as k,
    sum(case when substr(audit, spot, 1) <> 'D' then 1 else 0 end)
      over (partition by conv_id order by spot) as place
  from letters),
placed as (
  select e.conv_id, e.spot, e.edit, e.place, j.role, j.text,
    max(case when e.place = 1 and e.edit = 'K' and j.initial = 's' then 1 else 0 end)
      over (partition by e.conv_id) as system
  from edits e left join judged j on e.conv_id is not distinct from j.conv_id
    and e.edit <> 'I' and e.k = j.k
  where e.edit <> 'D'),
written as (
  select conv_id, string_agg(case when edit = 'K' then role
      when (place - system) % 2 = 1 then 'user' else 'assistant' end || ':' ||
      case when edit = 'I' then '' else text end, chr(10) order by spot) as said
  from placed group by conv_id)
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank,
  coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, coalesce(best.c, 0) as cost, coalesce(best.s, '') as audit,
  sha256(coalesce(said, '')) as repaired_sha256
from (select distinct conv_id from conversations) c
  left join per on c.conv_id is not distinct from per.conv_id
  left join written on c.conv_id is not distinct from written.conv_id"""


ORACLE_SQL: dict[str, str] = {
    "op4_repeats": _repeats(),
    "op5_chat": _chat(),
    "op9_warc": _warc(),
    "op11_licenses": _licenses(),
    "op13_repair": _repair(),
}
