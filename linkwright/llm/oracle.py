"""DuckDB SQL of the text queries that SQL can express, written out from the contracts."""

from __future__ import annotations

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

MIXING = rf"""
with d as (
  select doc_id, source, cast(len({WORDS}) as bigint) as size,
         coalesce(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')), 0) as signs,
         (cast(cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 13) as bigint) as double) + 0.5)
           / 4503599627370496.0 as u
  from documents),
k as (select *, -ln(u) / (1.0 / (1.0 + 4.0 * signs / (size + 1))) as key from d),
s as (
  select source, cast(sum(size) as bigint) as n,
         case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as w
  from k group by source),
f as (
  select *, sum(n) over () - coalesce(sum(3 * n) over before, 0) as words_left,
         sum(w) over () - coalesce(sum(w) over before, 0) as weight_left
  from s window before as (order by 3 * n / w, source nulls last rows between unbounded preceding and 1 preceding)),
t as (
  select source, n, least(cast(3 * n as double), max(cast(words_left as double) / weight_left) over () * w) as target
  from f),
p as (
  select k.doc_id, k.size, t.n, t.target, cast(round(t.target) as bigint) as goal,
         coalesce(sum(k.size) over (partition by k.source order by k.key, k.doc_id, k.size
                                    rows between unbounded preceding and 1 preceding), 0) as ahead
  from k join t on k.source is not distinct from t.source)
select doc_id, size, n as source_size, target,
       cast(case when n = 0 then 0 else (goal // n) * size + greatest(0, least(size, goal - (goal // n) * n - ahead)) end
            as bigint) as taken
from p
"""


def quality_rules() -> str:
    """Counts by unnesting words and windows; then medians, and three concentration steps per language and source."""
    floors = (250.0, 100.0, 30.0, 40.0)
    axes = range(4)
    pairs = [(i, j) for i in axes for j in axes if i <= j]
    group = "g.lang is not distinct from v.lang and g.source is not distinct from v.source"
    sql = [rf"""
with w as (
  select rowid as r, doc_id, lang, source, text, {WORDS} as ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
  from (select *, row_number() over () as rowid from documents)),
win as (
  select r, i, ws[i:i+4] as five from (select r, ws, unnest(range(1, len(ws) - 3)) as i from w)),
twice as (
  select r, unnest(range(i, i + 5)) as pos from (select r, i, count(*) over (partition by r, five) as n from win) where n > 1),
rep as (select r, count(distinct pos) as n from twice group by r),
c as (
  select w.r, doc_id, lang, source, cast(len(ws) as bigint) as n_words,
         cast(length(array_to_string(ws, '')) as bigint) as word_chars,
         cast(coalesce(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')), 0) as bigint) as n_symbols,
         cast(coalesce(length(regexp_replace(text, '[^A-Z]+', '', 'g')), 0) as bigint) as n_upper,
         cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
         cast(coalesce(rep.n, 0) as bigint) as n_repeat_words
  from w left join rep on w.r = rep.r),
b as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from c),
m as (select lang, source, cast(sum(word_chars) as double) / sum(n_words) as mean_len from b
      where not base_failed group by lang, source),
v as (
  select v.r, v.lang, v.source,
         cast(round(1000 * (word_chars - mean_len * n_words) / (n_words + 100)) as bigint) as x0,
         cast(round(1000 * ln(1 + 20.0 * n_symbols / (word_chars + 100))) as bigint) as x1,
         cast(round(1000.0 * n_upper / (word_chars + 100)) as bigint) as x2,
         cast(round(1000.0 * n_repeat_words / (n_words + 20)) as bigint) as x3
  from b v join m g on {group} where not base_failed),
q as (select lang, source, """ + ", ".join(f"quantile_cont(x{i}, 0.5) as q{i}" for i in axes) + f"""
      from v group by lang, source),
h as (select v.lang, v.source, """ + ", ".join(
        f"max(q{i}) as q{i}, quantile_cont(abs(x{i} - q{i}), 0.5) as mad{i}" for i in axes) + f"""
      from v join q g on {group} group by v.lang, v.source),
e0 as (select v.*, """ + " + ".join(
        f"(x{i} - q{i}) * (x{i} - q{i}) / greatest({f * f}, pow(1.4826 * mad{i}, 2.0))"
        for i, f in enumerate(floors)) + f" as d2 from v join h g on {group})"]
    rank = "cast(least(round(100 * v.d2), 1000000.0) as bigint)"
    for k in range(3):
        cov = {(i, j): f"(p{i}{j} / n - (s{i} / n) * (s{j} / n) + {floors[i] ** 2 if i == j else 0.0})" for i, j in pairs}
        # the triangle is written out column by column, each from those before
        steps, done = [], "n, lang, source, " + ", ".join(f"s{i} / n as m{i}" for i in axes)
        for j in axes:
            cols = [f"{cov[j, j]}" + "".join(f" - l{j}{t} * l{j}{t} * d{t}" for t in range(j)) + f" as d{j}"]
            steps.append((j, cols[0], [(i, f"({cov[j, i]}" + "".join(f" - l{i}{t} * l{j}{t} * d{t}" for t in range(j)) + ")")
                                       for i in range(j + 1, 4)]))
        chain = f"select *, {', '.join(f's{i} / n as m{i}' for i in axes)} from s{k}"
        for j, d, lows in steps:
            chain = f"select *, {d} from ({chain})"
            if lows:
                chain = f"select *, {', '.join(f'{t} / d{j} as l{i}{j}' for i, t in lows)} from ({chain})"
        y = "select v.r, v.lang, v.source, x0, x1, x2, x3, x0 - m0 as y0, g.* exclude (lang, source) " \
            f"from v join g{k} g on {group}"
        for i in range(1, 4):
            y = f"select *, x{i} - m{i}" + "".join(f" - l{i}{t} * y{t}" for t in range(i)) + f" as y{i} from ({y})"
        sql.append(f"""
cut{k} as (select lang, source, quantile_cont({rank}, 0.5) as cut from e{k} v group by lang, source),
s{k} as (select v.lang, v.source, cast(count(*) as double) as n, """ + ", ".join(
            f"cast(sum(x{i}) as double) as s{i}" for i in axes) + ", " + ", ".join(
            f"cast(sum(x{i} * x{j}) as double) as p{i}{j}" for i, j in pairs) + f"""
  from e{k} v join cut{k} g on {group} where {rank} <= g.cut group by v.lang, v.source),
g{k} as ({chain}),
e{k + 1} as (select r, lang, source, x0, x1, x2, x3, """ + " + ".join(f"y{i} * y{i} / d{i}" for i in axes) + f"""
  as d2 from ({y}))""")
    sql.append(f"""
z as (select lang, source, quantile_cont({rank}, 0.5) as mid from e3 v group by lang, source),
k as (select v.r, v.d2 / greatest(1.0, mid / 100 / 3.3567) < 40.0 as kept from e3 v join z g on {group})""")
    return ",".join(sql) + """
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(k.kept, false) as kept
from b left join k on b.r = k.r
"""


FINITE = "embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"


def whole(scale: int) -> str:
    return f"list_transform(embedding, lambda x: cast(floor({scale} * cast(x as double)) as bigint))"


def vector_codes() -> str:
    """Two rounds over all entries of each part position, then the final codes."""
    sql = [f"""
with k as (select row_number() over () as r, vec_id, label, {whole(256)} as v from embeddings where {FINITE}),
p as (select r, vec_id, part, v[part * (len(v) // 16) + 1:(part + 1) * (len(v) // 16)] as c
      from (select *, unnest(range(16)) as part from k)),
b0 as (select part, entry, c from (
  select part, row_number() over (partition by part order by vec_id) - 1 as entry, c from p) where entry < 64)"""]
    for k in range(3):
        sql.append(f"""
a{k} as (select r, part, m % 256 as entry, m // 256 as d from (
  select p.r, p.part, min(256 * list_sum(list_transform(list_zip(p.c, b.c), lambda z: cast((z[1] - z[2]) * (z[1] - z[2]) as hugeint)))
                          + b.entry) as m
  from p join b{k} b on p.part = b.part group by p.r, p.part))""")
        if k < 2:
            sql.append(f"""
n{k} as (select part, entry, list((s - ((s % n + n) % n)) // n order by j) as c from (
  select p.part, a.entry, j, sum(p.c[j]) as s, count(*) as n
  from (select *, unnest(range(1, len(c) + 1)) as j from p) p join a{k} a on a.r = p.r and a.part = p.part
  group by p.part, a.entry, j) group by part, entry),
b{k + 1} as (select b.part, b.entry, coalesce(list_transform(n.c, lambda x: cast(x as bigint)), b.c) as c
      from b{k} b left join n{k} n on n.part = b.part and n.entry = b.entry)""")
    return ",".join(sql) + """,
e as (select r, string_agg(printf('%02x', cast(entry as bigint)), '' order by part) as code, cast(sum(d) as bigint) as error from a2 group by r)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
       (select sha256(string_agg(array_to_string(c, ','), ',' order by part, entry)) from b2) as codebooks_sha256
from k join e on k.r = e.r
"""


TOP_K = f"""
with k as (select row_number() over () as r, vec_id, {whole(64)} as v from embeddings where {FINITE}),
s as (select q.r, q.vec_id as query_id, c.vec_id,
             cast(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) as bigint) as score
      from k q join k c on c.r <> q.r where q.vec_id % 20 = 0)
select query_id, cast(row_number() over best as int) as rank, vec_id, score from s
window best as (partition by r order by score desc, vec_id nulls last)
qualify row_number() over best <= 20
"""


def conversation_repair() -> str:
    """Row by row, the cheapest edits up to each state of the pattern, as text that sorts by cost and then audit."""
    step = lambda frm, cost, letters: f"(substr({frm}, 1, 9)::int + {cost})::varchar || substr({frm}, 10) || '{letters}'"
    # inserts: from nothing, system or assistant to user and on to assistant, from user to assistant and on to user
    ins = {"z": "z", "s": "s",
           "u": f"least(u, {step('z', 3, 'I')}, {step('s', 3, 'I')}, {step('a', 3, 'I')})",
           "a": f"least(a, {step('u', 3, 'I')}, {step('z', 6, 'II')}, {step('s', 6, 'II')})"}
    keep = lambda frm, letter, cost: f"case when {letter} then {step(frm, cost, 'K')} end"
    can = "not gone"
    # the number in front is 100000000 + cost; a state that cannot be reached is NULL, which least() passes over
    step_k = {
        "z": step("z", 4, "D"),
        "s": f"least({step('s', 4, 'D')}, {keep('z', can + ' and first = $$s$$', 'extra')})",
        "u": "least(" + ", ".join([step("u", 4, "D")] + [x for f in "zsa" for x in (
            keep(f, can + " and first = $$u$$", "extra"), f"case when {can} then {step(f, '(3 + extra)', 'R')} end")]) + ")",
        "a": f"least({step('a', 4, 'D')}, {keep('u', can + ' and first = $$a$$', 'extra')}, "
             f"case when {can} then {step('u', '(3 + extra)', 'R')} end)"}
    step_k = {k: v.replace("$$", "'") for k, v in step_k.items()}
    columns = lambda by: ", ".join(f"{v} as {k}" for k, v in by.items())
    return rf"""
with recursive t as (
  select list(v order by i) as tab from (
    select i, list_reduce(list_concat([cast(i as bigint)], range(8)),
                          lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v from range(256) r(i))),
h as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         xor(list_reduce(list_concat([cast(4294967295 as bigint)], list_transform(
               string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''),
               lambda x: cast(ascii(x) as bigint))), lambda c, b: xor(tab[xor(c & 255, b) + 1], c >> 8)), 4294967295) % 20 as kind
  from conversations, t),
d as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
         case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(case when kind = 3 then [0, 1] else [0] end) as copy
  from h where kind <> 0),
o as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text)) as i,
         substr(role, 1, 1) as first, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as seen from d),
f as (
  select *, case when seen = '' then 'blank' when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
                 when right(seen, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
         lag(first) over (partition by conv_id order by i) || first as pair
  from o),
w as (select *, fault in ('blank', 'duplicate') as gone, case when fault = 'truncated' then 3 else 0 end as extra from f),
g as (
  select conv_id, max(i) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
         count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
         count(*) filter (fault = 'truncated') as truncated, count(*) filter (pair not in ('su', 'ua', 'au')) as illegal
  from w group by conv_id),
ids as (select distinct conv_id from conversations),
s as (
  select conv_id, 0 as pos, '100000000' as z, cast(null as varchar) as s, cast(null as varchar) as u, cast(null as varchar) as a
  from g
  union all
  select conv_id, pos + 1, {columns(step_k)}
  from (select x.conv_id, x.pos, w.first, w.gone, w.extra, {columns(ins)}
        from (select * from s) x join w on w.conv_id is not distinct from x.conv_id and w.i = x.pos + 1)),
e as (
  select g.*, least(s.z, {ins['a']}) as best from s join g on g.conv_id is not distinct from s.conv_id and s.pos = g.n),
c as (select *, cast(substr(best, 1, 9) as int) - 100000000 as cost, substr(best, 10) as audit from e),
l as (select conv_id, audit, unnest(range(1, length(audit) + 1)) as j from c),
q as (
  select *, substr(audit, j, 1) as edit, length(replace(audit, 'D', '')) as total,
         length(replace(substr(audit, 1, j), 'I', '')) as i, length(replace(substr(audit, 1, j), 'D', '')) - 1 as line from l),
m as (
  select q.conv_id, q.j, case when edit = 'K' then w.role when (line - total % 2) % 2 = 0 then 'user' else 'assistant' end || ':' ||
         case when edit = 'I' then '' else w.text end as row
  from q left join w on w.conv_id is not distinct from q.conv_id and w.i = q.i where edit <> 'D'),
r as (select conv_id, sha256(string_agg(row, chr(10) order by j)) as digest from m group by conv_id)
select ids.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, cast(coalesce(cost, 0) as bigint) as cost,
       coalesce(audit, '') as audit, coalesce(digest, sha256('')) as repaired_sha256
from ids left join c on c.conv_id is not distinct from ids.conv_id left join r on r.conv_id is not distinct from ids.conv_id
"""


ORACLE_SQL = {
    "op2_quality_rules": quality_rules(),
    "op3_source_mixing": MIXING,
    "op11_vector_codes": vector_codes(),
    "op12_top_k": TOP_K,
    "op13_conversation_repair": conversation_repair(),
}
