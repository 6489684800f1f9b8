"""DuckDB SQL of the operators that SQL can express, in plain forms that share nothing with the operators."""

from __future__ import annotations

#: The reversed polynomial of CRC-32, and its start and final mask.
_POLYNOMIAL, _MASK = 0xEDB88320, 0xFFFFFFFF
_SHIFTED = f"case when c % 2 = 1 then xor(c >> 1, {_POLYNOMIAL}) else c >> 1 end"

#: CTEs ``bits`` and ``crc_table(t)``: the table of CRC-32, as DuckDB has no such function.
CRC_TABLE = f"""
    bits(b, step, c) as (
        select b, 0, b from (select unnest(range(256))::bigint as b)
        union all
        select b, step + 1, {_SHIFTED} from bits where step < 8
    ), crc_table as (select list(c order by b) as t from bits where step = 8)
"""


def crc32(text: str) -> str:
    """CRC-32 of the UTF-8 of a text of code points below U+0100, with the column ``t`` of `CRC_TABLE` in reach."""
    octets = (
        f"flatten(list_transform(string_split({text}, ''), lambda ch: case when unicode(ch) < 128 then [unicode(ch)::bigint]"
        " else [(192 + (unicode(ch) >> 6))::bigint, (128 + (unicode(ch) & 63))::bigint] end))"
    )
    return f"xor(list_reduce({octets}, lambda crc, o: xor(crc >> 8, t[(xor(crc, o) & 255) + 1]), {_MASK}::bigint), {_MASK})"


_NONE = 1000000000


def _option(cost: str, letters: str, state: int, lines: str = "[]") -> str:
    """An edit of a row, or the end of one of its options, that goes on from the next row's best in ``state``."""
    return f"{{'cost': {cost} + n.best[{state}].cost, 'audit': '{letters}' || n.best[{state}].audit, 'lines': list_concat({lines}, n.best[{state}].lines)}}"


def _consume(state: int) -> str:
    """The best of Delete, Keep and Rerole in a state: 1 start, 2 after system, 3 after user, 4 after assistant."""
    fitting, role = (4, "assistant") if state == 3 else (3, "user")
    kept = {1: "case initial when 's' then 2 when 'u' then 3 end", 2: "case initial when 'u' then 3 end"}
    kept |= {3: "case initial when 'a' then 4 end", 4: kept[2]}
    extra = "case fault when 'truncated' then 5 else 0 end"
    options = [
        _option("2", "D", state),
        f"case when fault in ('blank', 'duplicate') then null else {_option(f'1 + {extra}', 'R', fitting, f'''['{role}:' || text]''')} end",
    ]
    for target in {1: (2, 3), 2: (3,), 3: (4,), 4: (3,)}[state]:
        fits = f"fault not in ('blank', 'duplicate') and {kept[state]} = {target}"
        options.append(f"case when {fits} then {_option(extra, 'K', target, '''[role || ':' || text]''')} end")
    return f"list_sort(list_filter([{', '.join(options)}], lambda o: o is not null))[1]"


def _with_inserts(state: int) -> str:
    """The best in a state, with up to two insertions before the row is edited."""
    def after(base: int, letters: str, lines: str) -> str:
        return f"{{'cost': {5 * len(letters)} + row{base}.cost, 'audit': '{letters}' || row{base}.audit, 'lines': list_concat({lines}, row{base}.lines)}}"

    if state == 3:
        options = ["row3", after(4, "I", "['assistant:']")]
    else:
        options = [f"row{state}", after(3, "I", "['user:']"), after(4, "II", "['user:', 'assistant:']")]
    return f"list_sort([{', '.join(options)}])[1]"


CONVERSATION_REPAIR = rf"""
    with recursive {CRC_TABLE}, filled as (
        select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
               coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as drawn
        from conversations
    ), damaged as (
        select conv_id, turn, case draw when 4 then 'user' else role end as role,
               case draw when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
               unnest(range(case draw when 0 then 0 when 3 then 2 else 1 end)) as copy
        from (select *, {crc32('drawn')} % 20 as draw from filled, crc_table)
    ), numbered as (
        select *, left(role, 1) as initial,
               row_number() over (partition by conv_id order by turn nulls first, role, md5(text), copy) as pos,
               row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as seen,
               regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as last
        from damaged
    ), faulted as (
        select *, case when last = '' then 'blank' when seen > 1 then 'duplicate'
                       when last not in ('.', '!', '?') then 'truncated' else '' end as fault,
               lag(initial) over (partition by conv_id order by pos) || initial as pair
        from numbered
    ), counted as (
        select conv_id, count(*) as n_rows,
               coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
               count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
               count(*) filter (fault = 'truncated') as truncated,
               count(*) filter (pair is not null and pair not in ('su', 'ua', 'au')) as illegal
        from faulted group by conv_id
    ), walk(conv_id, pos, best) as (
        select conv_id, n_rows + 1, [
            {{'cost': 0, 'audit': '', 'lines': []::varchar[]}},
            {{'cost': 10, 'audit': 'II', 'lines': ['user:', 'assistant:']}},
            {{'cost': 5, 'audit': 'I', 'lines': ['assistant:']}},
            {{'cost': 0, 'audit': '', 'lines': []::varchar[]}}]
        from counted
        union all
        select conv_id, pos, [{', '.join(_with_inserts(state) for state in (1, 2, 3, 4))}]
        from (
            select f.conv_id, f.pos, {', '.join(f'{_consume(state)} as row{state}' for state in (1, 2, 3, 4))}
            from walk n join faulted f on f.conv_id is not distinct from n.conv_id and f.pos = n.pos - 1
        )
    ), ids as (select distinct conv_id from conversations)
    select i.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
           coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
           coalesce(w.best[1].cost, 0)::bigint as cost, coalesce(w.best[1].audit, '') as audit,
           sha256(coalesce(array_to_string(w.best[1].lines, chr(10)), '')) as repaired_sha256
    from ids i left join counted c on c.conv_id is not distinct from i.conv_id
    left join walk w on w.conv_id is not distinct from i.conv_id and w.pos = 1
"""

_RUNS = r"[A-Za-z\x{00C0}-\x{00FF}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: DuckDB's edit distance counts octets, so letters beyond ASCII are compared as other characters of one octet.
_WIDE, _NARROW = "".join(map(chr, range(0xC0, 0x100))), "".join(map(chr, range(0x21, 0x61))).replace("'", "''")

SPELLING = rf"""
    with recursive {CRC_TABLE}, runs as (
        select doc_id, run, count(*) as n from (
            select doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_RUNS}')) as run from documents
        ) group by all
    ), drawn as (
        select run, n, {crc32("coalesce(doc_id::varchar, '') || ':' || run")} as h from runs, crc_table
    ), words as (
        select word, sum(n)::bigint as n from (
            select case when h % 31 = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, n
            from drawn
        ) where length(word) >= 7 group by word having sum(n) >= 2
    ), pieces as (
        select word, n, translate(word, '{_WIDE}', '{_NARROW}') as plain, length(word) as l,
               half, case half when 0 then left(word, 3) else right(word, 3) end as piece
        from words, (select unnest([0, 1]) as half)
    ), near as (
        select distinct a.word, a.n, b.word as other, b.n as other_n
        from pieces a join pieces b on a.half = b.half and a.piece = b.piece and a.l between b.l - 1 and b.l + 1 and a.word <> b.word
        where levenshtein(a.plain, b.plain) = 1
    ), formed as (
        select w.word, w.n, count(other) as n_near, max(other_n) as most,
               min({{'minus': -other_n, 'other': other}}) filter (other is not null) as best
        from words w left join near using (word) group by w.word, w.n
    ), forms as (
        select word, n, n_near, case when most >= 10 * n then best.other end as form, case when most >= 10 * n then most end as form_n
        from formed
    ), walk as (
        select word, word as at, form as further from forms
        union all
        select w.word, w.further, f.form from walk w join forms f on f.word = w.further
    )
    select f.word, f.form, w.at as root, f.n, f.n_near, f.form_n
    from forms f join walk w on w.word = f.word and w.further is null
"""

NGRAM_JOIN = rf"""
    with recursive worded as (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') as w from documents
    ), sets as (
        select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
            else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as shingles
        from worded
    ), tokens as (select doc_id, len(shingles) as size, unnest(shingles) as shingle from sets),
    met as (
        select a.doc_id as a, b.doc_id as b, a.size as a_size, b.size as b_size, count(*) as common
        from tokens a join tokens b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all
    ), links as (select a, b from met where 100 * common >= 80 * (a_size + b_size - common)),
    edges as (select a, b from links union all select b, a from links),
    reach as (
        select doc_id as a, doc_id as b from sets
        union
        select r.a, e.b from reach r join edges e on e.a = r.b
    ), least as (select a, min(b) as component_id from reach group by a)
    select doc_id, len(shingles)::bigint as n_shingles, component_id from sets join least on a = doc_id
"""
