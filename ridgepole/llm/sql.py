"""SQL twins of the queries, where SQL can express them (DuckDB dialect)."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# CRC-32 of a text's UTF-8 bytes, by its table of 256 steps
_CRC_TABLE = "[list_reduce([i::bigint] || range(8), lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) for i in range(256)]"
_CRC = (
    "xor(list_reduce([4294967295::bigint] || list_transform(range(strlen(text)), lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::bigint), "
    "lambda a, b: xor(steps[(xor(a, b) & 255) + 1], a >> 8)), 4294967295)"
)


def _draw(name: str, weight: float) -> str:
    return f"(-ln((('0x' || substr(md5('{name}:' || key), 1, 13))::bigint + 0.5) / 4503599627370496.0) / {weight!r})"


def _winner(children: list[tuple[str, float, int]]) -> str:
    if len(children) == 1:
        return str(children[0][2])
    return "list_min([" + ", ".join(f"{{'draw': {_draw(n, w)}, 'child': {i}}}" for n, w, i in children) + "])['child']"


def _tree_sql(shards: int, grown: bool) -> tuple[str, str, str]:
    """CASE expressions for region, rack and shard of equal shards in regions of 2 racks of 2."""
    nodes = [(i // 4, i % 4 // 2, i) for i in range(shards)] + ([(shards // 4, 0, shards)] if grown else [])
    regions = sorted({n[0] for n in nodes})
    racks = sorted({n[:2] for n in nodes})
    region = _winner([(f"region {r}", float(sum(n[0] == r for n in nodes)), r) for r in regions])
    rack = "case region " + " ".join(
        f"when {r} then {_winner([(f'rack {p[0]}.{p[1]}', float(sum(n[:2] == p for n in nodes)), i) for i, p in enumerate(racks) if p[0] == r])}" for r in regions
    ) + " end"
    shard = "case rack " + " ".join(
        f"when {i} then {_winner([(f'shard {n[2]}', 1.0, n[2]) for n in nodes if n[:2] == p])}" for i, p in enumerate(racks)
    ) + " end"
    return region, rack, shard


def _placed(source: str, grown: bool, out: str) -> str:
    region, rack, shard = _tree_sql(16, grown)
    return f"select * exclude (region, rack), cast({shard} as int) as {out} from (select *, {rack} as rack from (select *, {region} as region from {source}))"


ORACLE["op2_sharding"] = f"""
with crc as (select {_CRC_TABLE} as steps),
rows as (select doc_id, coalesce(strlen(text), 0) + 1 as size, case when text = '' then 0 else {_CRC} end as text_crc32,
    coalesce(doc_id::varchar, 'null') as key from (select *, hex(encode(text)) as digits from documents), crc),
one as ({_placed("rows", False, "shard")}),
two as ({_placed("one", True, "grown_shard")}),
cut as (select *, (('0x' || substr(md5('slot:' || key), 1, 8))::bigint * (select greatest(1, (count(*) + 49999) // 50000) from documents)) >> 32 as block from two)
select doc_id, size, text_crc32, 'key' as law, shard,
    row_number() over (partition by shard order by block, doc_id nulls first, size, text_crc32) - 1 as slot, grown_shard
from cut"""


ORACLE["op3_near_dedup"] = """
with recursive good as (
    select vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings
    where vec_id is not null and len(embedding) > 0 and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
      and list_bool_or(list_transform(embedding, lambda x: x <> 0))),
unit as (select vec_id, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) as u from good),
links as (select a.vec_id as a, b.vec_id as b from unit a join unit b on a.vec_id <> b.vec_id and list_inner_product(a.u, b.u) >= 0.9),
reach as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
least as (select a, least(a, min(b)) as component_id from reach group by a),
counts as (select a, count(*) as n_links from links group by a)
select e.vec_id, coalesce(c.n_links, 0) as n_links, coalesce(l.component_id, e.vec_id) as component_id, coalesce(l.component_id, e.vec_id) = e.vec_id as kept
from embeddings e left join counts c on c.a = e.vec_id left join least l on l.a = e.vec_id"""

ORACLE["op7_jaccard_join"] = r"""
with recursive low as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sets as (
    select doc_id, list_distinct(case when len(w) >= 5 then [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]
                                      when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from low),
flat as (select doc_id, len(s) as n, unnest(s) as shingle from sets),
links as (
    select a.doc_id as a, b.doc_id as b from flat a join flat b on a.shingle = b.shingle and a.doc_id <> b.doc_id
    group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
least as (select a, least(a, min(b)) as component_id from reach group by a)
select s.doc_id, len(s.s) as n_shingles, coalesce(l.component_id, s.doc_id) as component_id from sets s left join least l on l.a = s.doc_id"""

_SIZED = r"""
sized as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    md5('0:' || coalesce(doc_id::varchar, 'null')) as h, coalesce('=' || source, '-') as src from documents),
placed as (select *, (('0x' || substr(h, 1, 8))::bigint * (select greatest(1, (count(*) + 49999) // 50000) from documents)) >> 32 as cell,
    ('0x' || substr(h, 9, 8))::bigint as ord from sized)"""

# the highest quotients, listed one by one; ties go to the earlier source or cell
ORACLE["op9_mixing"] = f"""
with {_SIZED},
cells as (select src, any_value(source) as source, cell, sum(size)::bigint as cell_size from placed group by src, cell),
sources as (select src, any_value(source) as source, sum(cell_size)::bigint as source_size from cells group by src),
ranked as (select *, row_number() over (order by source nulls last) - 1 as r, sum(source_size) over () as total from sources),
weighed as (select *, ([5.0, 2.0, 1.0]::double[])[r % 3 + 1] as weight from ranked),
leveled as (select *, (total - coalesce(sum(3 * source_size) over (order by source_size * 3 / weight, r rows between unbounded preceding and 1 preceding), 0))::double
    / sum(weight) over (order by source_size * 3 / weight, r rows between current row and unbounded following) as level from weighed),
stopped as (select *, source_size * 3 <= level * weight as stops from leveled),
targets as (select *, case when stops then source_size * 3.0::double else coalesce(max(case when not stops then level end) over (), 0) * weight end as target,
    greatest(1, least(4096, total::bigint >> 20)) as block from stopped),
seats as (select src, target / (2 * k + 1) as q, r, total, block from (select *, unnest(range((source_size * 3 + block - 1) // block)) as k from targets where target > 0)),
won as (select src, count(*) as quota from (select *, row_number() over (order by q desc, r) as place from seats) where place <= total // block group by src),
cell_seats as (select c.src, c.cell, c.cell_size / (2 * k + 1) as q, w.quota from
    (select c.*, unnest(range((c.cell_size * 3 + t.block - 1) // t.block)) as k from cells c join targets t using (src)) c join won w using (src)),
cell_won as (select src, cell, count(*) as quota from (select *, row_number() over (partition by src order by q desc, cell) as place from cell_seats) where place <= quota group by src, cell),
settled as (select c.src, c.cell, c.cell_size, t.source_size, t.target, least(coalesce(w.quota, 0) * t.block, 3 * c.cell_size)::bigint as words, t.block,
    ((('0x' || substr(md5('0:' || c.src || ':' || c.cell::varchar), 1, 8))::bigint * greatest(1, (c.cell_size + t.block - 1) // t.block)) >> 32) * t.block as first
    from cells c join targets t using (src) left join cell_won w using (src, cell)),
lined as (select *, sum(size) over (partition by src, cell order by ord, doc_id, size rows between unbounded preceding and current row)::bigint as stop from placed),
joined as (select l.*, l.stop - l.size as start, s.source_size, s.target, s.cell_size, s.first,
    case when s.cell_size = 0 then 0 else s.words // s.cell_size end as passes, case when s.cell_size = 0 then 0 else s.words % s.cell_size end as more
    from lined l join settled s using (src, cell))
select doc_id, source, size, source_size, target,
    (passes * size + greatest(0, least(stop, least(first + more, cell_size)) - greatest(start, first)) + greatest(0, least(stop, first + more - cell_size) - start))::bigint as taken
from joined"""

ORACLE["op10_chat_quotes"] = """
select conv_id, turn, role, text, lag(turn) over w as parent_turn, min(turn) over (partition by conv_id) as root_turn,
    row_number() over w - 1 as depth, row_number() over w - 1 as position
from conversations window w as (partition by conv_id order by turn)"""


def _cheapest_steps() -> str:
    """(symbol, state before, state after, cost, letters, roles made) of a row and the inserts before it."""
    made, kept = {0: 2, 1: 2, 2: 3, 3: 2}, {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    rows = []
    for initial in "suao":
        for kind, more in (("fine", 0), ("truncated", 3), ("goes", None)):
            for start in range(4):
                found: dict[int, tuple] = {}
                state, cost, letters, roles = start, 0, "", []
                for _ in range(4):
                    ways = [(state, cost + 4, letters + "D", [*roles])]
                    if more is not None:
                        if (state, initial) in kept:
                            ways.append((kept[state, initial], cost + more, letters + "K", [*roles, "own"]))
                        ways.append((made[state], cost + 3 + more, letters + "R", [*roles, "new:" + ("user" if made[state] == 2 else "assistant")]))
                    for to, c, audit, out in ways:
                        found[to] = min(found.get(to, (99, "", [])), (c, audit, out))
                    state, cost, letters = made[state], cost + 3, letters + "I"
                    roles = [*roles, "add:" + ("user" if state == 2 else "assistant")]
                for to, (c, audit, out) in found.items():
                    rows.append(f"('{initial}', '{kind}', {start}, {to}, {c}, '{audit}', {out if out else '[]::varchar[]'})")
    return "steps(initial, kind, s, t, cost, letters, roles) as (values " + ", ".join(rows) + ")"


ORACLE["op11_turn_repair"] = rf"""
with recursive crc as (select {_CRC_TABLE} as steps),
keyed as (select *, hex(encode(k)) as digits from (select *,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations)),
kinds as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as said,
    ({_CRC.replace("strlen(text)", "strlen(k)")}) % 20 as kind from keyed, crc),
damaged as (select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then regexp_replace(said, '[.!?]', '', 'g') else said end as said, unnest(range(case when kind = 3 then 2 else 1 end)) as copy
    from kinds where kind <> 0),
ends as (select *, rtrim(said, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as cut,
    row_number() over (partition by conv_id order by turn nulls first, role, md5(said), copy) as i from damaged),
faults as (select *, case when cut = '' then 'blank' when row_number() over (partition by conv_id, role, said order by i) > 1 then 'duplicate'
    when right(cut, 1) not in ('.', '!', '?') then 'truncated' else 'fine' end as fault, left(role, 1) as initial from ends),
counts as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
    count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated, count(*) as n from faults group by conv_id),
pairs as (select conv_id, count(*) filter (pair is not null and pair not in ('su', 'ua', 'au')) as illegal
    from (select conv_id, lag(initial) over (partition by conv_id order by i) || initial as pair from faults) group by conv_id),
{_cheapest_steps()},
rows as (select conv_id, i, role, said, case when initial in ('s', 'u', 'a') then initial else 'o' end as initial,
    case when fault in ('blank', 'duplicate') then 'goes' else fault end as kind from faults),
ways as (
    select conv_id, 0::bigint as i, 0 as state, 0::bigint as cost, '' as audit, []::varchar[] as body from counts
    union all
    select conv_id, i, t, best.cost, best.audit, best.body from (
        select w.conv_id, r.i, s.t, min({{'cost': w.cost + s.cost, 'audit': w.audit || s.letters, 'body': w.body || list_transform(s.roles,
            lambda x: case when x = 'own' then r.role || ':' || r.said when x[1:3] = 'new' then x[5:] || ':' || r.said else x[5:] || ':' end)}}) as best
        from ways w join rows r on r.conv_id is not distinct from w.conv_id and r.i = w.i + 1 join steps s on s.initial = r.initial and s.kind = r.kind and s.s = w.state
        group by w.conv_id, r.i, s.t)),
ended as (select w.conv_id, min({{'cost': w.cost + e.cost, 'audit': w.audit || e.letters, 'body': w.body || e.roles}}) as best
    from ways w join counts c on c.conv_id is not distinct from w.conv_id and c.n = w.i
    join (values (0, 0, '', []::varchar[]), (1, 6, 'II', ['user:', 'assistant:']), (2, 3, 'I', ['assistant:']), (3, 0, '', []::varchar[])) e(state, cost, letters, roles) on e.state = w.state
    group by w.conv_id)
select o.conv_id, coalesce(c.gaps, 0)::bigint as gaps, coalesce(c.blank, 0) as blank, coalesce(c.duplicate, 0) as duplicate, coalesce(c.truncated, 0) as truncated,
    coalesce(p.illegal, 0) as illegal, coalesce(e.best.cost, 0)::bigint as cost, coalesce(e.best.audit, '') as audit,
    sha256(coalesce(array_to_string(e.best.body, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) o left join counts c on c.conv_id is not distinct from o.conv_id
left join pairs p on p.conv_id is not distinct from o.conv_id left join ended e on e.conv_id is not distinct from o.conv_id"""

ORACLE["op12_collocations"] = r"""
with pieces as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
grams as (select lang, 1 as size, unnest(w) as gram from words
    union all select lang, 2, unnest([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) from words
    union all select lang, 3, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) from words),
counts as (select lang, size, gram, count(*) as f from grams group by all),
candidates as (select *, string_split(gram, ' ') as p from counts where size > 1 and f >= 10),
cuts as (select *, unnest(range(1, size)) as k from candidates),
scored as (select c.lang, c.size, c.gram, c.f, c.p, l.f as l, r.f as r, c.k, (1000000::hugeint * c.f * c.f) // (l.f::hugeint * r.f) as score
    from cuts c join counts l on l.lang = c.lang and l.gram = array_to_string(c.p[1:c.k], ' ') and l.size = c.k
    join counts r on r.lang = c.lang and r.gram = array_to_string(c.p[c.k + 1:], ' ') and r.size = c.size - c.k),
lowest as (select * from scored qualify row_number() over (partition by lang, gram, size order by score, k) = 1),
parts as (select lang, f, unnest([p[1] || ' ' || p[2], p[2] || ' ' || p[3]]) as gram from candidates where size = 3),
inside as (select distinct c.lang, c.gram from candidates c join parts d on d.lang = c.lang and d.gram = c.gram and c.size = 2 where 100 * d.f >= 50 * c.f),
stays as (select * from lowest s where not exists (select 1 from inside i where i.lang = s.lang and i.gram = s.gram and s.size = 2)),
totals as (select lang, count(*) as n from grams where size = 1 group by lang),
ranked as (select *, row_number() over (partition by lang order by score desc, f desc, gram) as rank from stays)
select lang, rank, gram as phrase, f as a, l, r, n, score::bigint as score from ranked join totals using (lang) where rank <= 2000"""
