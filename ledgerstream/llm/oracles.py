"""Queries of this subpackage as SQL, where SQL can express them."""

ORACLES: dict[str, str] = {}

ORACLES["op1_poisson_mixing"] = """
with recursive sized as (
    select source, sum(coalesce(octet_length(encode(text)), 0) + 1) as size from documents group by source
), rated as (
    select source, pow(size, 0.5) / sum(pow(size, 0.5)) over () * sum(size) over () / size as rate from sized
), split as (
    select source, greatest(ceil(rate / 8), 1)::int as draws, rate / greatest(ceil(rate / 8), 1) as mean from rated
), steps as (
    select source, draws, mean, 0 as k, exp(-mean) as p, exp(-mean) as c from split
    union all
    select source, draws, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) from steps where k < 64
), laws as (
    select source, any_value(draws) as draws, list(c order by k) as law from steps group by source
), counted as (
    select d.*, list_sum(list_transform(range(1, l.draws + 1), lambda j: len(list_filter(l.law, lambda c: c <=
        (('0x' || substr(md5('17|' || coalesce(d.doc_id::varchar, '') || '|' || j), 1, 13))::bigint + 0.5)
        / 4503599627370496)))) as n
    from documents d join laws l on d.source is not distinct from l.source
), copies as (
    select doc_id, text, lang, source, n_chars, unnest(range(1, n::bigint + 1))::int as copy from counted where n > 0
)
select *, ('0x' || substr(md5('18|' || coalesce(doc_id::varchar, '') || '|' || copy), 1, 15))::bigint as mix_key
from copies
"""

# The table of CRC-32 follows from its polynomial by eight shifts of each byte.
CRCS = """
shifted as (
    select b, 0 as step, b::bigint as r from range(256) t(b)
    union all
    select b, step + 1, case when r & 1 = 1 then xor(r >> 1, 3988292384) else r >> 1 end from shifted where step < 8
), crcs as (
    select list(r order by b) as t from shifted where step = 8
)"""

ORACLES["op2_byte_shards"] = """
with recursive """ + CRCS + """, sized as (
    select doc_id, coalesce(octet_length(encode(text)), 0) + 16 as size, md5(text) as digest,
        xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(octet_length(encode(text))),
            lambda i: ('0x' || substr(hex(encode(text)), 2 * i + 1, 2))::bigint)),
            lambda r, b: xor(r >> 8, t[(xor(r, b) & 255) + 1])), 4294967295) as text_crc32
    from documents, crcs
), summed as (
    select *, sum(size) over w as upto, sum(size) over () as total, row_number() over w - 1 as place from sized
    window w as (order by digest nulls first, doc_id nulls first rows unbounded preceding)
), cut as (
    select *, ((40 * (2 * upto - size)) // (2 * total))::int as shard from summed
)
select doc_id, size::bigint as size, text_crc32, 'bytes' as law, shard,
    place - min(place) over (partition by shard) as slot, null::int as grown_shard
from cut
"""


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::varchar)) || ':' || {value}::varchar, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


def _levels(name: str, group: str, first: str, n: int) -> str:
    """Levels 1 to n above ``first`` (group, place, node, path so far, folded version, its row's leaf place)."""
    parts, before = [], first
    for level in range(1, n + 1):
        parts.append(f"""
{name}{level} as (
    select {group}, place // 3 as place, case when any_value(n) = 1 then any_value(node)
        else sha256(string_agg(node, '' order by place)) end as node
    from (select *, count(*) over (partition by {group}) as n from {before}) group by {group}, place // 3
)""")
        before = f"{name}{level}"
    return ",".join(parts)


def _climb(name: str, group: str, rows: str, first: str, tree: str, n: int) -> str:
    """Carries each row's proof and folded node up n levels of a tree."""
    parts, before = [], rows
    for level in range(1, n + 1):
        nodes = first if level == 1 else f"{tree}{level - 1}"
        parts.append(f"""
{name}{level} as (
    select c.* replace (c.spot // 3 as spot, c.proof || coalesce(l.before, '') || coalesce(l.after, '') as proof,
        case when l.alone then c.folded
            else sha256(coalesce(l.before, '') || c.folded || coalesce(l.after, '')) end as folded)
    from {before} c join (
        select {group}, place, count(*) over (partition by {group}) = 1 as alone, string_agg(node, '') over (
                partition by {group}, place // 3 order by place rows between unbounded preceding and 1 preceding) as before,
            string_agg(node, '') over (
                partition by {group}, place // 3 order by place rows between 1 following and unbounded following) as after
        from {nodes}
    ) l on c.{group} is not distinct from l.{group} and c.spot = l.place
)""")
        before = f"{name}{level}"
    return ",".join(parts)


# Levels: enough for 3^14 rows of a source and 3^7 sources.
DEEP, WIDE = 14, 7
ORACLES["op12_merkle_manifest"] = f"""
with recursive {CRCS}, leaves as (
    select doc_id, source, {_leaf('text')} as node,
        row_number() over (partition by source order by doc_id nulls first, {_leaf('text')}) - 1 as place,
        case when doc_id is not null and xor(list_reduce(list_prepend(4294967295::bigint, list_transform(
            range(length(doc_id::varchar)), lambda i: ascii(substr(doc_id::varchar, i + 1, 1))::bigint)),
            lambda r, b: xor(r >> 8, t[(xor(r, b) & 255) + 1])), 4294967295) % 2 = 0
            then {_leaf("replace(text, chr(10), '')")} else {_leaf('text')} end as changed
    from documents, crcs
), {_levels('n', 'source', 'leaves', DEEP)}, subroots as (
    select '' as one, source, node, row_number() over (order by source is not null, encode(source)) - 1 as place
    from n{DEEP}
), {_levels('m', 'one', 'subroots', WIDE)}, start as (
    select doc_id, source, node as leaf, place as spot, '' as proof, changed as folded from leaves
), {_climb('c', 'source', 'start', 'leaves', 'n', DEEP)}, middle as (
    select c.* replace (s.place as spot), s.node as subroot, '' as one
    from c{DEEP} c join subroots s on c.source is not distinct from s.source
), {_climb('d', 'one', 'middle', 'subroots', 'm', WIDE)}
select doc_id, leaf, subroot, m.node as root, sha256(proof) as proof_sha256, folded as folded_root,
    folded = m.node as verified
from d{WIDE} d, m{WIDE} m
"""

ORACLES["op11_collocation_tiles"] = r"""
with lowered as (
    select row_number() over () as d, coalesce(lang, 'und') as lang,
        regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]') as ps
    from documents where text is not null
), pieces as (
    select d, lang, generate_subscripts(ps, 1) as p, unnest(ps) as piece from lowered
), split as (
    select d, lang, p, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') as ws from pieces
), words as (
    select d, lang, p, generate_subscripts(ws, 1) as i, unnest(ws) as w from split
), runs as (
    select lang, w, lead(w) over s as w2, lead(w, 2) over s as w3 from words window s as (partition by d, p order by i)
), one as (
    select lang, w, count(*) as f from words group by all
), two as (
    select lang, w, w2, count(*) as f from runs where w2 is not null group by all having count(*) >= 10
), three as (
    select lang, w, w2, w3, count(*) as f from runs where w3 is not null group by all having count(*) >= 10
), longer as (
    select lang, w, w2, max(f) as f from (
        select lang, w, w2, f from three union all select lang, w2, w3, f from three) group by all
), pairs as (
    select t.lang, t.w || ' ' || t.w2 as phrase, t.f as a, x.f as l, y.f as r,
        1000000 * t.f::hugeint * t.f // (x.f::hugeint * y.f) as score
    from two t join one x on x.lang = t.lang and x.w = t.w join one y on y.lang = t.lang and y.w = t.w2
    left join longer g on g.lang = t.lang and g.w = t.w and g.w2 = t.w2
    where g.f is null or 100 * g.f < 50 * t.f
), cuts as (
    select t.lang, t.w || ' ' || t.w2 || ' ' || t.w3 as phrase, t.f as a, x.f as l1, yz.f as r1, xy.f as l2, z.f as r2,
        1000000 * t.f::hugeint * t.f // (x.f::hugeint * yz.f) as s1,
        1000000 * t.f::hugeint * t.f // (xy.f::hugeint * z.f) as s2
    from three t join one x on x.lang = t.lang and x.w = t.w join one z on z.lang = t.lang and z.w = t.w3
    join two xy on xy.lang = t.lang and xy.w = t.w and xy.w2 = t.w2
    join two yz on yz.lang = t.lang and yz.w = t.w2 and yz.w2 = t.w3
), scored as (
    select * from pairs union all
    select lang, phrase, a, if(s1 <= s2, l1, l2), if(s1 <= s2, r1, r2), least(s1, s2) from cuts
), totals as (
    select lang, sum(f) as n from one group by lang
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r,
    n::bigint as n, score::bigint as score
from scored join totals using (lang) qualify rank <= 2000
"""

# Bytes as two hex digits each.
ORACLES["op13_suffix_repeats"] = """
with numbered as (
    select row_number() over () as d, doc_id, hex(encode(coalesce(text, ''))) as h from documents
), starts as (
    select d, i, md5(substr(h, 2 * i + 1, 400)) as s
    from (select d, h, unnest(range(greatest(length(h) // 2 - 199, 0))) as i from numbered)
), met as (
    select d, i from starts qualify count(*) over (partition by s) > 1
), runs as (
    select d, i, i > coalesce(max(i) over (partition by d order by i rows between unbounded preceding and 1 preceding), -400)
        + 200 as new from met
), spans as (
    select d, nth, min(i) as a, max(i) + 200 as b
    from (select *, sum(new::int) over (partition by d order by i) as nth from runs) group by d, nth
), sums as (
    select d, sum(b - a) as removed, count(*) as n, list([a, b] order by a) as cut from spans group by d
)
select doc_id, (length(h) // 2)::bigint as n_bytes, coalesce(removed, 0)::bigint as n_removed, coalesce(n, 0) as n_spans,
    sha256(unhex(case when cut is null then h else array_to_string(list_transform(range(len(cut) + 1), lambda k: substr(h,
        2 * (if(k = 0, 0, cut[k][2])) + 1, 2 * (if(k = len(cut), length(h) // 2, cut[k + 1][1]) - if(k = 0, 0, cut[k][2])))),
        '') end)) as kept_sha256
from numbered left join sums using (d)
"""
