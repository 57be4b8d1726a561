"""The same results in DuckDB SQL, as text for the driver's comparison.

The views follow FIXTURES.md; each query carries only the views it needs.
"""

from __future__ import annotations

import re

_ID = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_DUP_KEY = (
    "ref_idx, neg, case when neg then pos + ref_len - 1 else pos - case cigar when '10S90M' then 10 else 0 end end"
)
# Number of the letter at position pos + o of a contig, modulo 4.
_LETTER = "((pos+o)*(pos+o) + (pos+o)//3 + ref_idx)"
_CONTIG_KEY = (
    "case upper(substring(contig,4,9)) when 'X' then 25 when 'Y' then 26 else try_cast(substring(contig,4,9) as int) end"
)
_KMERS = """
select {id}, w*512 + i as i, substring(part, i, 24) as k
from (select {id}, w, part, unnest(generate_series(1, greatest(length(part)-23, 1), {step})) as i
 from (select {id}, w, substring(text, w*512+1, 535) as part
  from (select {id}, text, unnest(generate_series(0, (greatest(length(text)-23, 1)-1)//512)) as w from {table})))
"""

_ACGT = "'0123456789abcdef', 'ACGTACGTACGTACGT'"


def _part_text(part: str) -> str:
    key = f"cast(case when ({part}) // 24 % 10 = 5 then ({part}) - 120 else {part} end as varchar)"
    return f"translate(concat(sha256({key}), sha256(concat({key}, 'x'))), {_ACGT})"


_PAIR = "ok, ln, pk, sk"
_WORN = ", ".join(f"substring(s, {13 * i + 1}, 12), translate(substring(s, {13 * i + 13}, 1), 'ACGT', 'CGTA')" for i in range(5))
_FLIP = "reverse(translate({}, 'ACGT', 'TGCA'))"
# Bases from the forward to the reverse end of places a and b.
_FRAGMENT = """case when a.neg <> b.neg and a.ref_idx = b.ref_idx then
 case when a.neg then case when b.loc <= a.loc then a.loc + 64 - b.loc end else case when a.loc <= b.loc then b.loc + 64 - a.loc end end end"""

# In order: a view uses only views above it.
VIEWS = {
    "reads": f"""
select {_ID},
 cast(l_partkey % 27 as int) - 1 as ref_idx,
 cast(1 + (l_orderkey*7919 + l_partkey*104729 + l_linenumber*31) % 200000 as int) as pos,
 case l_linenumber % 5 when 0 then '100M' when 1 then '10S90M' when 2 then '50M2D48M' when 3 then '40M3I57M' else '60M20N40M' end as cigar,
 case l_linenumber % 5 when 0 then 100 when 1 then 90 when 2 then 100 when 3 then 97 else 120 end as ref_len,
 cast(l_quantity as int) as mapq, l_returnflag = 'R' and l_linestatus = 'F' as neg,
 cast(l_suppkey % 4 as int) as chunk
from lineitem""",
    "placed": "select *, pos + ref_len - 1 as end_pos from reads where ref_idx > 0 and ref_idx <= 24",
    "dense": f"select {_ID}, ref_idx, cast(1 + pos % 2000 as int) as pos, cigar, ref_len, mapq, neg from reads",
    "contigs": """
select n_nationkey as ref_idx, concat('chr', case n_nationkey when 0 then 'M' when 23 then 'X' when 24 then 'y'
 else cast(n_nationkey as varchar(9)) end) as contig, 1900 + n_nationkey as length from nation""",
    "targets": """
select p_partkey, cast(p_partkey % 24 as int) + 1 as ref_idx, cast((p_partkey*7919) % 200000 as int) as start0,
 cast((p_partkey*7919) % 200000 + 150 + p_size*10 as int) as end0 from part""",
    "counts": "select ref_idx, cast(count(*) as bigint) as c from placed group by ref_idx",
    "regions": """
with recursive o as (select ref_idx, c, row_number() over(order by c desc, ref_idx) rn from counts),
 f as (select cast(0 as bigint) rn, cast(null as int) ref_idx, cast(null as int) region, cast([0,0,0,0] as bigint[]) sums
 union all select o.rn, o.ref_idx, cast(list_position(f.sums, list_min(f.sums)) as int),
  list_transform(f.sums, lambda v,i: case when i = list_position(f.sums, list_min(f.sums)) then v + o.c else v end)
  from f join o on o.rn = f.rn+1)
select ref_idx, region from f where rn > 0""",
    "covered": f"""
with g as (select *, max(end_pos) over(partition by ref_idx order by pos,end_pos,{_ID} rows between unbounded preceding and 1 preceding) pm from placed),
 h as (select *, sum(case when pm is null or pos > pm+51 then 1 else 0 end) over(partition by ref_idx order by pos,end_pos,{_ID} rows between unbounded preceding and current row) grp from g)
select ref_idx, min(pos) as s, max(end_pos) as e, cast(count(*) as bigint) as n from h group by ref_idx, grp""",
    "quals": """
select *, list_transform(range(0,10), lambda i: cast((l_orderkey+i*7)%10 + case when ref_idx%3=0 then
 case when l_linenumber%2=0 then 60 else 40 end else 51 end as int)) as quals from placed""",
    "bases": """
select rid, ok, ln, pk, sk, ref_idx, cast(pos + o as int) as p, cast((ok+ln+o) % 8 as int) as cyc, cast(20 + (ok+o) % 20 as int) as q,
 (ok*31+sk*7+o) % 97 = 0 or ((pos+o) % 151 = 0 and (ok+pk) % 2 = 0) as mm
from (select row_number() over () rid, l_orderkey ok, l_linenumber ln, l_partkey pk, l_suppkey sk, cast(1+l_partkey%24 as int) ref_idx,
 cast(1+(l_orderkey*7919+l_partkey*104729+l_linenumber*31)%3000 as int) pos, unnest(range(0,50)) o from lineitem) r""",
    "letters": f"""
select rid, ok, ln, pk, sk, ref_idx, p, o, sk % 2 = 0 as neg, ln % 2 = 0 as second, cast(20 + (ok+o) % 20 as int) as q, mm,
 substring('ACGT', cast(g % 4 as int) + 1, 1) as rb,
 substring('ACGT', cast((g + case when mm then 1 + (ok+o) % 3 else 0 end) % 4 as int) + 1, 1) as b
from (select *, pos + o as p, {_LETTER} as g, (ok*31+sk*7+o) % 97 = 0 or ((pos+o) % 151 = 0 and (ok+pk) % 2 = 0) as mm
 from (select row_number() over () rid, l_orderkey ok, l_linenumber ln, l_partkey pk, l_suppkey sk, cast(1+l_partkey%24 as int) ref_idx,
  cast(1+(l_orderkey*7919+l_partkey*104729+l_linenumber*31)%3000 as int) pos, unnest(range(0,50)) o from lineitem))""",
    "alleles": """
select a.ref_idx, a.p, rb as ref, b as alt, dp, ad, cast(mass - 3010*dp as bigint) as qual_milli
from (select ref_idx, p, rb, b, cast(count(*) as bigint) as ad, sum(q*1000) as mass from letters where b <> rb group by all) a
 join (select ref_idx, p, cast(count(*) as bigint) as dp from letters group by all) d on a.ref_idx = d.ref_idx and a.p = d.p""",
    "known": "select distinct cast(1 + l_partkey % 24 as int) as ref_idx, cast(151*(l_partkey % 20) as int) as p from lineitem",
    "recal": """
select q, cyc, cast(count(*) as bigint) as n, cast(sum(case when mm then 1 else 0 end) as bigint) as err,
 cast(round(-10*log10((sum(case when mm then 1 else 0 end)+1.0)/(count(*)+2.0))) as int) as eq
from bases where not exists (select 1 from known k where k.ref_idx = bases.ref_idx and k.p = bases.p) group by q, cyc""",
    "pile": """
select ref_idx, p, cast(count(*) as bigint) as dp, cast(sum(case when mm then 1 else 0 end) as bigint) as ad,
 cast(sum(case when mm then q*1000 else 0 end) - 3010*count(*) as bigint) as qual_milli from bases group by ref_idx, p""",
    "truth": """
select l_partkey%26 as c, l_orderkey%500 as p, substring('ACGT',cast(l_linenumber%4 as int)+1,1) as r,
 substring('CGTA',cast(l_suppkey%4 as int)+1,1) as v from lineitem where l_linestatus='O'""",
    "calls": """
select l_partkey%26 as c, l_orderkey%500 as p, substring('ACGT',cast(l_linenumber%4 as int)+1,1) as r,
 substring('CGTA',cast(l_suppkey%4 as int)+1,1) as v from lineitem where l_linestatus='F'""",
    "loci": """
select ref_idx, pos + case cigar when '50M2D48M' then 50 else 40 end as locus, case cigar when '50M2D48M' then 'D' else 'I' end as op,
 cast(count(*) as bigint) as n from placed where cigar in ('50M2D48M','40M3I57M') group by 1,2,3""",
    "read_seeds": _KMERS.format(id="item_id", table="benchmark", step=8),
    "target_kmers": _KMERS.format(id="doc_id", table="documents", step=1),
    "votes": """
select item_id, doc_id, cast(target_kmers.i-read_seeds.i as bigint) as diag, cast(count(*) as bigint) as votes
from read_seeds join target_kmers on read_seeds.k=target_kmers.k group by 1,2,3 having count(*) >= 3""",
}


def _repeat_text(part: str) -> str:
    first = f"({part} - 24 * (({part}) // 24 % 3 - 1))"
    unit = f"left({_part_text(first)}, 1 + {first} % 4)"
    return f"case when ({part}) // 24 % 3 = 0 then {_part_text(part)} else left(repeat({unit}, 128), 128) end"


_PAIRS = ", ".join(f"('{a}', '{b}')" for i, a in enumerate("ACGT") for b in "ACGT"[i:])
# One base to the left while the last base of the change stands before it; the leftmost spelling stays.
_SHIFTED = """
with recursive moves as (
 select distinct ref_idx, s as s0, d as d0, u as u0, s, d || u as q from {changes}
 union all
 select m.ref_idx, s0, d0, u0, s - 1, substring(text, s - 1, 1) || left(q, length(q) - 1) as q
 from moves m join repeat_text t on t.ref_idx = m.ref_idx
 where s > 1 and (d0 = '') <> (u0 = '') and substring(text, s - 1, 1) = right(q, 1))
select ref_idx, s0, d0, u0, min(s) as ms, arg_min(q, s) as q from moves group by 1, 2, 3, 4"""
_ANCHORED = """
case when ms = 1 then 1 else ms - 1 end as pos,
case when ms > 1 then substring(text, ms - 1, 1) || case when d0 = '' then '' else q end
 else case when d0 = '' then '' else q end || substring(text, ms + length(d0), 1) end as ref,
case when ms > 1 then substring(text, ms - 1, 1) || case when d0 = '' then q else '' end
 else case when d0 = '' then q else '' end || substring(text, ms + length(d0), 1) end as alt"""

VIEWS |= {
    "repeat_text": f"""
select cast(p_partkey % 24 as int) as ref_idx, string_agg({_repeat_text("p_partkey")}, '' order by p_partkey) as text from part group by 1""",
    "gapped": f"""
select cast(l_partkey % 24 as int) as ref_idx, l_partkey // 24 * 128 + o as pos, kind, o, t
from (select l_partkey, l_linenumber % 5 as kind, cast((l_orderkey * 7 + l_linenumber * 13) % 8 * 16 + 1 as int) as o,
 concat({_repeat_text("l_partkey")}, {_repeat_text("(l_partkey + 24)")}) as t from lineitem)""",
    "gap_changes": """
select ref_idx, s, substring(text, s, n) as d, u, cast(count(*) as bigint) as ad from (
 select ref_idx, pos + 40 as s, 2 as n, '' as u from gapped where kind = 1
 union all select ref_idx, pos + 40, 0, substring(t, o + 37, 3) from gapped where kind = 2
 union all select ref_idx, pos + 20, 5, '' from gapped where kind = 3
 union all select ref_idx, pos + 35, 0, 'A' from gapped where kind = 3) x join repeat_text using (ref_idx)
where length(substring(text, s, n)) = n and s <= length(text) + 1 group by all""",
    "gap_moves": _SHIFTED.format(changes="gap_changes"),
    "gap_records": f"""
select ref_idx, cast(pos as int) as pos, ref, alt, cast(sum(ad) as bigint) as ad from (
 select m.ref_idx, {_ANCHORED}, ad from gap_moves m join gap_changes c on c.ref_idx = m.ref_idx and c.s = s0 and c.d = d0 and c.u = u0
 join repeat_text t on t.ref_idx = m.ref_idx) group by all""",
    "gap_blocks": """
select ref_idx, pos + b[1] as s, pos + b[2] as e from (select ref_idx, pos, unnest(case kind when 0 then [[0, 63]] when 1 then [[0, 39], [42, 65]]
 when 2 then [[0, 60]] when 3 then [[0, 19], [25, 34], [35, 67]] else [[0, 58]] end) as b from gapped)""",
    "gap_scores": """
select *, {'c': l0, 'g': '0/0'} as g0, {'c': l1 + 30000, 'g': '0/1'} as g1, {'c': l2 + 33010, 'g': '1/1'} as g2 from (
 select *, dp - ad as other, ad * 30000 + (dp - ad) * 4 as l0, dp * 3010 as l1, ad * 4 + (dp - ad) * 30000 as l2 from (
  select ref_idx, pos, ref, alt, ad, greatest(n, ad) as dp from (
   select r.ref_idx, r.pos, ref, alt, ad, cast(count(b.s) as bigint) as n
   from gap_records r left join gap_blocks b on b.ref_idx = r.ref_idx and r.pos between b.s and b.e group by r.ref_idx, r.pos, ref, alt, ad)))""",
    "spelled": f"""
select contig, ref_idx, pos, l_linestatus, kind, ref, unnest(string_split(upper(alt), ',')) as alt from (
 select concat('chr', l_partkey % 24) as contig, cast(l_partkey % 24 as int) as ref_idx, l_partkey // 24 * 128 + o as pos, l_linestatus, kind,
  case kind when 3 then substring(t, o, 1) when 1 then substring(t, o, 5) else substring(t, o, 3) end as ref,
  case kind when 0 then substring(t, o, 1) when 1 then concat(substring(t, o, 1), substring(t, o + 3, 2))
   when 2 then concat(substring(t, o, 1), ',', translate(substring(t, o, 1), 'ACGT', 'CGTA'), substring(t, o + 1, 2))
   else concat(substring(t, o, 1), substring(t, o + 1, 2)) end as alt
 from (select l_partkey, l_linestatus, l_linenumber % 4 as kind, {_repeat_text("l_partkey")} as t,
  cast(2 + (l_orderkey % 12) * 10 + l_suppkey % 2 * 2 as int) as o from lineitem))""",
    # The shared ends of the alleles cut off: first the longest equal ends, then the longest equal starts.
    "spelled_changes": """
select distinct ref_idx, l_linestatus, pos + h as s, substring(r, h + 1) as d, substring(a, h + 1) as u from (
 select *, coalesce(list_max(list_filter(range(0, least(length(r), length(a)) + 1), lambda k: left(r, k) = left(a, k))), 0) as h from (
  select *, left(ref, length(ref) - e) as r, left(alt, length(alt) - e) as a from (
   select *, list_max(list_filter(range(0, least(length(ref), length(alt)) + 1), lambda k: right(ref, k) = right(alt, k))) as e
   from spelled where ref <> alt)))""",
    "spelled_moves": _SHIFTED.format(changes="spelled_changes"),
    "spelled_keys": f"""
select distinct c.ref_idx, l_linestatus, case when (d = '') <> (u = '') then pos else c.s end as pos,
 case when (d = '') <> (u = '') then ref else d end as ref, case when (d = '') <> (u = '') then alt else u end as alt
from spelled_changes c join (select m.ref_idx, s0, d0, u0, {_ANCHORED} from spelled_moves m join repeat_text t on t.ref_idx = m.ref_idx) m
 on c.ref_idx = m.ref_idx and c.s = s0 and d = d0 and u = u0""",
    "genotype_likes": f"""
select ref_idx, p, ref, dp, g1, g2, cast(sum(case when b = g1 and b = g2 then agree when b = g1 or b = g2 then half else miss end) as bigint) as l,
 cast(sum(case when b = g1 and b = g2 then agree when b = g1 or b = g2 then half else miss end)
  + case when g1 = ref and g2 = ref then 0 when g1 = g2 then 33010 when g1 = ref or g2 = ref then 30000 else 60000 end as bigint) as c
from (select ref_idx, p, rb as ref, b, sum(count(*)) over (partition by ref_idx, p) as dp,
  sum(cast(round(-10000 * log10(1 - pow(10, -q / 10.0))) as bigint)) as agree,
  sum(cast(round(-10000 * log10(0.5 - pow(10, -q / 10.0) / 3)) as bigint)) as half, sum(q * 1000 + 4771) as miss
 from letters group by ref_idx, p, rb, b) x, (values {_PAIRS}) as g(g1, g2) group by ref_idx, p, ref, dp, g1, g2""",
    "genotype_best": """
select ref_idx, p, any_value(ref) as ref, any_value(dp) as dp, arg_min(g1, (c, g1, g2)) as a, arg_min(g2, (c, g1, g2)) as b,
 min(c) as best, list_sort(list(c))[2] - min(c) as gq, any_value(c) filter (g1 = ref and g2 = ref) - min(c) as qual,
 map_from_entries(list((g1 || g2, l))) as likes
from genotype_likes group by ref_idx, p having any_value(c) filter (g1 = ref and g2 = ref) > min(c)""",
    "mismatching": """
select ref_idx, p from bases group by ref_idx, p
having count(*) >= 4 and sum(case when mm then q else 0 end) > 0 and 100 * sum(case when mm then q else 0 end) >= 15 * sum(q)""",
    "clusters": """
select ref_idx, min(p) as s, max(p) as e, count(*) as n from (
 select *, sum(o) over (partition by ref_idx order by p) as g from (
  select ref_idx, p, case when p - lag(p) over (partition by ref_idx order by p) < 10 then 0 else 1 end as o from mismatching))
group by ref_idx, g having count(*) > 1""",
    "dense_loci": """
select ref_idx, pos + case cigar when '50M2D48M' then 50 else 40 end as locus, case cigar when '50M2D48M' then 'D' else 'I' end as op,
 cast(count(*) as bigint) as n from dense where cigar in ('50M2D48M','40M3I57M') and ref_idx between 1 and 24 group by 1,2,3""",
    "level_bases": """
select concat('g', pk % 3) as rg, q, cyc, mm from bases b
where pk % 3 > 0 and q <> 27 and not (q > 30 and cyc = 5) and not exists (select 1 from known k where k.ref_idx = b.ref_idx and k.p = b.p)""",
    "level_groups": "select rg, (count(*) filter (mm) + 1.0::double) / (count(*) + 2.0::double) as rate from level_bases group by rg",
    "level_quals": """
select rg, q, (err + 20 * g.rate) / (n + 20) as rate
from (select rg, q, count(*) as n, count(*) filter (mm) as err from level_bases group by rg, q) join level_groups g using (rg)""",
    "level_cycles": """
select rg, q, cyc, (err + 20 * p.rate) / (n + 20) as rate
from (select rg, q, cyc, count(*) as n, count(*) filter (mm) as err from level_bases group by rg, q, cyc) join level_quals p using (rg, q)""",
    # Contig, unclipped 5' position and strand in one number.
    "read_ends": f"""
select *, row_number() over (order by {_ID}) as no,
 (ref_idx + 1) * 34359738368 + (case when neg then pos + ref_len - 1 else pos - case cigar when '10S90M' then 10 else 0 end end + 8589934592) * 2
  + case when neg then 1 else 0 end as fe
from (select {_ID}, cast(1 + l_orderkey % 3 as int) as ref_idx, cast(1 + l_partkey % 6 * 40 as int) as pos, cigar, ref_len, mapq, neg,
 (l_linenumber - 1) // 2 as fragment, concat('lib', l_orderkey % 2) as lib, l_orderkey % 4 as tile,
 (l_orderkey * 37 + (l_linenumber - 1) // 2 * 5) % 300 as x, l_orderkey * 11 % 300 as y from reads)""",
    "end_marks": """
select r.*, pair_dup, coalesce(pair_dup, bool_or(pair_dup is not null) over (partition by lib, fe)
  or row_number() over (partition by lib, fe, pair_dup is null order by mapq desc, r.no) > 1) as is_dup,
 case when pair_dup is not null then pair_of when not bool_or(pair_dup is not null) over (partition by lib, fe)
  then first_value(r.no) over (partition by lib, fe, pair_dup is null order by mapq desc, r.no) end as equal_of
from read_ends r left join (
 select l_orderkey, fragment, row_number() over (partition by lib, lo, hi order by score desc, no) > 1 as pair_dup,
  first_value(no) over (partition by lib, lo, hi order by score desc, no) as pair_of
 from (select l_orderkey, fragment, lib, min(fe) as lo, max(fe) as hi, sum(mapq) as score, min(no) as no
  from read_ends group by l_orderkey, fragment, lib having count(*) = 2)) j on j.l_orderkey = r.l_orderkey and j.fragment = r.fragment""",
    "optical": """
select m.*, coalesce(m.is_dup and m.tile = k.tile and abs(m.x - k.x) <= 100 and abs(m.y - k.y) <= 100, false) as is_optical
from end_marks m left join end_marks k on k.no = m.equal_of and m.is_dup and not k.is_dup""",
    "fragment_counts": """
select lib, count(*) filter (n = 2) as pairs, count(*) filter (n = 2 and d) as pair_dups, count(*) filter (n = 2 and o) as pair_optical,
 cast(coalesce(sum(n) filter (n <> 2), 0) as bigint) as single, cast(coalesce(sum(ds) filter (n <> 2), 0) as bigint) as single_dups
from (select lib, l_orderkey, fragment, count(*) as n, bool_or(is_dup) as d, bool_or(is_optical) as o, count(*) filter (is_dup) as ds
 from optical group by all) group by lib""",
    "contig_text": f"""
select cast(p_partkey % 24 as int) as ref_idx, string_agg({_part_text("p_partkey")}, '' order by p_partkey) as text
from part group by 1""",
    "contig_kmers": """
select ref_idx, i as p, substring(text, i, 24) as k
from (select ref_idx, text, unnest(generate_series(1, length(text) - 23)) as i from contig_text)""",
    "pair_ends": f"""
select {_PAIR}, mate, case when (mate = 1) = (sk % 2 = 0) then s2 else s1 end as seq
from (select {_PAIR}, case when (ok + pk) % 40 = 0 then left(translate(sha256(concat('n', cast(ok as varchar))), {_ACGT}), 64)
  else left(f, 64) end as s1, case when (ok + ln) % 50 = 0 then concat({_WORN}) else s end as s2, unnest([1, 2]) as mate
 from (select *, {_FLIP.format("right(f, 64)")} as s from (
  select l_orderkey as ok, l_linenumber as ln, l_partkey as pk, l_suppkey as sk,
   substring(concat({", ".join(_part_text(f"l_partkey + {24 * i}") for i in range(4))}),
    (l_orderkey * 7 + l_linenumber * 13) % 64 + 1, 270 + (l_orderkey + l_suppkey * 3) % 60) as f from lineitem)))
where mate = 1 or (ok + 7 * pk) % 30 > 0""",
    "end_votes": f"""
select seq, neg, ref_idx, cast(p - i + 1 as int) as loc, cast(count(*) as bigint) as votes
from (select seq, neg, i, substring(t, i, 24) as k from (
 select seq, neg, t, unnest(generate_series(1, length(t) - 23, 8)) as i
 from (select distinct seq, false as neg, seq as t from pair_ends union all select distinct seq, true, {_FLIP.format("seq")} from pair_ends)))
join contig_kmers using (k) group by seq, neg, ref_idx, p - i having count(*) >= 3""",
    "end_places": """
select *, votes = most as is_best, count(*) filter (votes = most) over (partition by seq) = 1 as sole
from (select *, max(votes) over (partition by seq) as most from end_votes) where votes >= most - 3""",
    "end_alone": """
select seq, sole, {'ref_idx': ref_idx, 'loc': loc, 'neg': neg, 'votes': votes} as place from end_places
qualify row_number() over (partition by seq order by votes desc, ref_idx, loc, neg) = 1""",
    "end_pairs": f"""
select q1, q2, cast(count(*) as bigint) as n from (
 select {_PAIR}, max(seq) filter (mate = 1) as q1, max(seq) filter (mate = 2) as q2 from pair_ends group by all)
where q1 is not null and q2 is not null group by all""",
    "fragment_range": f"""
select greatest(cast(floor(q[1] - 3 * greatest(q[3] - q[1], 1)) as int), 1) as low, cast(floor(q[2]) as int) as centre,
 cast(ceil(q[3] + 3 * greatest(q[3] - q[1], 1)) as int) as high
from (select quantile_cont(len, [0.25, 0.5, 0.75]) as q, count(*) as c from (
 select {_FRAGMENT} as len, unnest(range(n)) from (
  select x.place as a, y.place as b, n from end_pairs join end_alone x on x.seq = q1 join end_alone y on y.seq = q2 where x.sole and y.sole))
 where len between 1 and 20000) where c >= 25""",
    "end_joint": f"""
select q1, q2, a, b, a.votes + b.votes as score from (
 select *, row_number() over (partition by q1, q2 order by a.votes + b.votes desc, abs(len - centre), a.ref_idx, a.loc, b.loc, a.neg) as rk
 from (select *, {_FRAGMENT} as len from (
  select q1, q2, {{'ref_idx': x.ref_idx, 'loc': x.loc, 'neg': x.neg, 'votes': x.votes}} as a,
   {{'ref_idx': y.ref_idx, 'loc': y.loc, 'neg': y.neg, 'votes': y.votes}} as b
  from end_pairs join end_places x on x.seq = q1 join end_places y on y.seq = q2 and x.ref_idx = y.ref_idx)) join fragment_range on true
 where len between low and high) where rk = 1""",
    "end_chosen": """
select q1, q2, sole_a, sole_b, coalesce(score >= sa.votes + sb.votes - 3, false) as proper,
 case when coalesce(score >= sa.votes + sb.votes - 3, false) then ja else sa end as a,
 case when coalesce(score >= sa.votes + sb.votes - 3, false) then jb else sb end as b
from (select p.q1, p.q2, x.place as sa, y.place as sb, x.sole as sole_a, y.sole as sole_b, j.a as ja, j.b as jb, j.score
 from end_pairs p left join end_alone x on x.seq = q1 left join end_alone y on y.seq = q2
 left join end_joint j on j.q1 = p.q1 and j.q2 = p.q2)""",
    "lost_ends": f"""
select q1, q2, m, case when m.neg then seq else {_FLIP.format("seq")} end as t,
 greatest(case when m.neg then m.loc + 64 - high else m.loc + low - 64 end, 1) as wlow,
 case when m.neg then m.loc + 64 - low else m.loc + high - 64 end as whigh
from (select q1, q2, coalesce(a, b) as m, case when a is null then q1 else q2 end as seq from end_chosen where (a is null) <> (b is null)) join fragment_range on true""",
    "end_found": """
select q1, q2, {'ref_idx': m.ref_idx, 'loc': loc, 'neg': not m.neg, 'votes': votes} as place from (
 select q1, q2, m, loc, cast(count(*) as bigint) as votes from (
  select w.q1, w.q2, w.m, w.wlow, w.whigh, cast(p - i + 1 as int) as loc from (
   select q1, q2, m, wlow, whigh, p, substring(text, p, 11) as k from (
    select q1, q2, m, wlow, whigh, text, unnest(generate_series(wlow, least(whigh + 53, length(text) - 10))) as p
    from lost_ends join contig_text on contig_text.ref_idx = m.ref_idx where whigh >= wlow)) w
  join (select q1, q2, i, substring(t, i, 11) as k from (select q1, q2, t, unnest(generate_series(1, 54)) as i from lost_ends)) s
   on s.q1 = w.q1 and s.q2 = w.q2 and s.k = w.k)
 where loc between wlow and whigh group by all having count(*) >= 4) join fragment_range on true
qualify row_number() over (partition by q1, q2 order by votes desc,
 abs(case when m.neg then m.loc + 64 - loc else loc + 64 - m.loc end - centre), loc) = 1""",
    "end_final": """
select c.q1, c.q2, sole_a, sole_b, coalesce(a, place) as a, coalesce(b, place) as b, proper or place is not null as proper
from end_chosen c left join end_found f on f.q1 = c.q1 and f.q2 = c.q2""",
}

_NEXT = ", ".join(f"lead(h, {j}) over along" for j in range(1, 8))
_MINIMISERS = """
select distinct {id}, cast(substring(m, 33, 9) as int) as i, substring(m, 42) as word from (
 select {id}, least(h, {following}) as m, row_number() over along as s, count(*) over (partition by no) as n
 from (select {id}, no, i, md5(word) || lpad(cast(i as varchar), 9, '0') || word as h from (
  select {id}, no, w*512 + i as i, substring(part, i, 15) as word from (
   select {id}, no, w, part, unnest(generate_series(1, length(part) - 14)) as i from (
    select {id}, no, w, substring(text, w*512 + 1, 526) as part from (
     select {id}, no, text, unnest(generate_series(0, (length(text) - 15)//512)) as w
     from (select {id}, text, row_number() over () as no from {table}) where length(text) >= 15)))))
 window along as (partition by no order by i))
where s <= greatest(n - 7, 1)"""
VIEWS |= {
    "item_words": _MINIMISERS.format(id="item_id", table="benchmark", following=_NEXT),
    "doc_words": _MINIMISERS.format(id="doc_id", table="documents", following=_NEXT),
    "item_anchors": """
select item_id, doc_id, k.i as x, d.i as y from item_words k join doc_words d using (word)""",
    # Lists of one anchor each, folded to the list of all with the best score that ends there.
    "item_ends": """
select item_id, doc_id, unnest(list_reduce(anchors, lambda done, b: list_append(done, {'y': b[1].y, 'x': b[1].x,
  'f': greatest(15, coalesce(list_max(list_transform(list_filter(done, lambda p: p.x < b[1].x and p.y < b[1].y),
   lambda p: cast(p.f + least(b[1].x - p.x, b[1].y - p.y, 15) - ceil(abs((b[1].x - p.x) - (b[1].y - p.y)) / 4) as int))), 15))}))) as e
from (select item_id, doc_id, list([{'y': y, 'x': x, 'f': 15}] order by y, x) as anchors
 from (select *, unnest([{'half': 0, 'band': cast(floor((y - x) / 128) as int)}, {'half': 1, 'band': cast(floor((y - x + 64) / 128) as int)}]) as b from item_anchors)
 group by item_id, doc_id, b)""",
}

QUERIES = {
    "placed_reads": f"select {_ID}, ref_idx, pos from placed",
    "alignment_end": f"select {_ID}, cast(end_pos as int) as end_pos from placed",
    "contig_sort_key": f"select ref_idx, {_CONTIG_KEY} as contig_key from contigs",
    "contig_counts": "select ref_idx, c from counts",
    "region_assignment": "select ref_idx, region from regions",
    "region_load": """
select region, cast(sum(c) as bigint) as n from regions join counts on regions.ref_idx = counts.ref_idx group by region""",
    "read_region": f"select {_ID}, region from placed join regions on placed.ref_idx = regions.ref_idx",
    "sorted_alignments": f"""
select {_ID}, region, cast(row_number() over(partition by region order by placed.ref_idx,pos,{_ID}) as bigint) as rn
from placed join regions on placed.ref_idx = regions.ref_idx""",
    "chunk_counts": "select chunk, cast(count(*) as bigint) as n from placed group by chunk",
    "chunk_union": """
select l_orderkey, ref_idx from placed where chunk = 0 union all select l_orderkey, ref_idx from placed where chunk = 1
union all select l_orderkey, ref_idx from placed where chunk = 2 union all select l_orderkey, ref_idx from placed where chunk = 3""",
    "clean_clip": f"""
select {_ID}, case when dense.pos <= length and dense.pos + ref_len - 1 > length then dense.pos + ref_len - 1 - length else 0 end as clipped
from dense join contigs on contigs.ref_idx = dense.ref_idx""",
    "read_groups": f"""
select {_ID}, 'GROUP1' as rg_id, 'LIB1' as rg_lb, 'ILLUMINA' as rg_pl, 'UNIT1' as rg_pu, 'SAMPLE1' as rg_sm from placed""",
    "quality_encoding": f"select {_ID}, case when list_max(quals) <= 60 then 'SANGER' else 'ILLUMINA' end as encoding from quals",
    "quality_fix": f"""
select ref_idx, shift, cast(sum(list_sum(case when shift then list_transform(quals, lambda x: x-31) else quals end)) as bigint) as tot
from (select *, first_value(list_max(quals)) over (partition by ref_idx order by pos,{_ID}) > 60 as shift from quals) group by ref_idx, shift""",
    "mark_duplicates": f"""
select {_ID}, row_number() over(partition by {_DUP_KEY} order by mapq desc,{_ID}) > 1 as is_dup from dense where ref_idx between 1 and 24""",
    "dup_metrics": f"""
select lib, cast(count(*) as bigint) as n, cast(sum(case when d then 1 else 0 end) as bigint) as dups,
 cast(sum(case when d then 1 else 0 end) as double) / count(*) as fraction
from (select concat('LIB', l_suppkey % 3) as lib, row_number() over(partition by l_suppkey % 3, {_DUP_KEY} order by mapq desc,{_ID}) > 1 as d
 from dense where ref_idx between 1 and 24) x group by lib""",
    "dup_counts": f"""
select cast(count(*) as bigint) as n, cast(sum(case when d then 1 else 0 end) as bigint) as dups
from (select row_number() over(partition by {_DUP_KEY} order by mapq desc,{_ID}) > 1 as d from dense where ref_idx between 1 and 24) x""",
    "covered_intervals": "select ref_idx, s, e, n from covered",
    "bed_lines": """
select concat(contig, chr(9), cast(s-1 as varchar(12)), chr(9), cast(e as varchar(12))) as line
from covered join contigs on contigs.ref_idx = covered.ref_idx""",
    "region_strings": """
select concat(contig, ':', cast(s as varchar(12)), '-', cast(e as varchar(12))) as region_string
from covered join contigs on contigs.ref_idx = covered.ref_idx""",
    "interval_span": """
select ref_idx, min(s) as first_start, max(e) as last_end, cast(count(*) as bigint) as n from covered group by ref_idx""",
    "interval_label": """
select concat(cast(n as varchar(12)), 'regions_', contig, '-', cast(first_start as varchar(12))) as label
from (select ref_idx, min(s) first_start, count(*) n from covered group by ref_idx) x join contigs on contigs.ref_idx = x.ref_idx""",
    "merged_ranges": """
select first(contig order by s, contig) as contig, greatest(min(s)-300,1) as s, max(e) as e from (
 select *, sum(case when pm is null or s - 300 >= pm then 1 else 0 end) over(partition by upper(contig) order by s,e rows between unbounded preceding and current row) grp
 from (select *, max(e) over(partition by upper(contig) order by s,e rows between unbounded preceding and 1 preceding) pm
  from (select case when s % 2 = 0 then upper(contig) else contig end as contig, s, e from covered join contigs on contigs.ref_idx = covered.ref_idx) i) g) h
group by upper(contig), grp""",
    "interval_intersect": """
select t.p_partkey, t.ref_idx, greatest(t.start0, c.s-1) as start0, least(t.end0, c.e) as end0
from targets t join covered c on t.ref_idx = c.ref_idx and t.start0 < c.e and c.s-1 < t.end0""",
    "restrict_to_targets": f"""
select {_ID} from placed where exists (select 1 from targets t where t.ref_idx = placed.ref_idx and t.start0 < placed.end_pos and placed.pos - 1 < t.end0)""",
    "indel_loci": "select ref_idx, locus, op, n from loci",
    "indel_targets": """
select ref_idx, min(s) as s, max(e) as e, cast(sum(n) as bigint) as support from (
 select *, sum(case when pm is null or s > pm then 1 else 0 end) over(partition by ref_idx order by s,e,op rows between unbounded preceding and current row) grp
 from (select *, max(e) over(partition by ref_idx order by s,e,op rows between unbounded preceding and 1 preceding) pm
  from (select ref_idx, greatest(locus-10,1) s, locus+10 e, n, op from loci) i) g) h
group by ref_idx, grp""",
    "recal_table": "select q, cyc, n, err, eq from recal",
    "recal_apply": """
select ok, ln, pk, sk, string_agg(cast(coalesce(eq, bases.q) as varchar), ',' order by p) as quals, cast(sum(coalesce(eq, bases.q)) as bigint) as new_q
from bases left join recal on recal.q = bases.q and recal.cyc = bases.cyc group by rid, ok, ln, pk, sk""",
    "aligned_bases": """
select ref_idx, cyc, context, cast(count(*) as bigint) as n, cast(count(*) filter (mm) as bigint) as err, cast(sum(q) as bigint) as sum_q,
 cast(sum(p) as bigint) as sum_p, cast(count(*) filter (b = 'A') as bigint) as n_a
from (select l.*, cast((case when neg then 50 - o else o + 1 end) * (case when second then -1 else 1 end) as int) as cyc,
 case when neg then translate(lead(b) over along, 'ACGT', 'TGCA') || translate(b, 'ACGT', 'TGCA') else lag(b) over along || b end as context
 from letters l window along as (partition by rid order by o)) x
where not exists (select 1 from known k where k.ref_idx = x.ref_idx and k.p = x.p) group by ref_idx, cyc, context""",
    "pileup_alleles": "select ref_idx, cast(p as int) as p, ref, alt, dp, ad, qual_milli from alleles",
    "pileup": "select ref_idx, p, dp, ad, qual_milli from pile",
    "called_variants": "select ref_idx, p, dp, ad, qual_milli from pile where qual_milli >= 30000",
    "variants_per_region": """
select region, cast(count(*) as bigint) as n from pile join regions on regions.ref_idx = pile.ref_idx where qual_milli >= 30000 group by region""",
    "variants_sorted": f"""
select contig, p as pos, substring('ACGT', cast(p % 4 as int) + 1, 1) as ref, substring('CGTA', cast(p % 4 as int) + 1, 1) as alt,
 concat('DP=', dp, ';AD=', ad) as info, cast(row_number() over(order by {_CONTIG_KEY}, contig, p) as bigint) as rn
from pile join contigs on contigs.ref_idx = pile.ref_idx where qual_milli >= 30000""",
    "concordance": """
select cast(count(*) as bigint) as total, cast(count(m.c) as bigint) as matches, cast(count(*) - count(m.c) as bigint) as diff
from (select distinct c,p,r,v from truth) a left join (select distinct c,p,r,v from calls) m
 on a.c = m.c and a.p = m.p and a.r = m.r and a.v = m.v""",
    "matched_variants": "select c,p,r,v from truth intersect select c,p,r,v from calls",
    "missed_variants": "select c,p,r,v from truth except select c,p,r,v from calls",
    "seed_votes": "select item_id, doc_id, diag, votes from votes",
    "seed_best": """
select item_id, doc_id, diag, votes
from (select *, row_number() over(partition by item_id order by votes desc, doc_id, diag) rk from votes) x where rk = 1""",
    "realignment_targets": """
select ref_idx, cast(min(s) as int) as s, cast(max(e) as int) as e, cast(sum(n) as bigint) as support from (
 select *, sum(case when pm is null or s > pm then 1 else 0 end) over(partition by ref_idx order by s,e,n rows between unbounded preceding and current row) grp
 from (select *, max(e) over(partition by ref_idx order by s,e,n rows between unbounded preceding and 1 preceding) pm
  from (select ref_idx, greatest(locus-10,1) s, locus+10 e, n from dense_loci union all select ref_idx, greatest(s-10,1), e+10, n from clusters) i) g) h
group by ref_idx, grp""",
    "recal_by_levels": """
select ok, ln, pk, sk, string_agg(cast(case when g is null then q else
 least(greatest((coalesce(l, g) + coalesce(c - coalesce(l, g), 0) + 500) // 1000, 1), 93) end as varchar), ',' order by p) as quals
from (select b.rid, b.ok, b.ln, b.pk, b.sk, b.p, b.q, cast(round(-10000 * log10(g.rate)) as int) as g,
  cast(round(-10000 * log10(l.rate)) as int) as l, cast(round(-10000 * log10(c.rate)) as int) as c
 from bases b left join level_groups g on g.rg = concat('g', pk % 3) left join level_quals l on l.rg = concat('g', pk % 3) and l.q = b.q
 left join level_cycles c on c.rg = concat('g', pk % 3) and c.q = b.q and c.cyc = b.cyc) group by rid, ok, ln, pk, sk""",
    "genotypes": """
select ref_idx, cast(p as int) as p, ref, array_to_string(alts, ',') as alt, cast(dp as bigint) as dp,
 array_to_string(list_transform(alleles, lambda x: cast(coalesce(counts[x], 0) as varchar)), ',') as ad,
 concat(least(list_position(alleles, a), list_position(alleles, b)) - 1, '/', greatest(list_position(alleles, a), list_position(alleles, b)) - 1) as gt,
 array_to_string(list_transform(shown, lambda x: cast(cast(round((x - list_min(shown)) / 1000.0) as bigint) as varchar)), ',') as pl,
 gq as gq_milli, qual as qual_milli
from (select *, flatten(list_transform(range(1, len(alleles) + 1), lambda k: list_transform(range(1, k + 1),
  lambda j: likes[least(alleles[j], alleles[k]) || greatest(alleles[j], alleles[k])]))) as shown
 from (select *, list_concat([ref], alts) as alleles from (select *, list_sort(list_distinct(list_filter([a, b], lambda x: x <> ref))) as alts from genotype_best))) g
join (select ref_idx, p, map_from_entries(list((b, n))) as counts from (select ref_idx, p, b, count(*) as n from letters group by all) group by all) c
 using (ref_idx, p)""",
    "gap_alleles": "select ref_idx, pos, ref, alt, ad from gap_records",
    "gap_genotypes": """
select ref_idx, pos as p, ref, alt, dp, concat(other, ',', ad) as ad, gs[1].g as gt,
 array_to_string(list_transform([l0, l1, l2], lambda x: cast(cast(round((x - least(l0, l1, l2)) / 1000.0) as bigint) as varchar)), ',') as pl,
 gs[2].c - gs[1].c as gq_milli, l0 - gs[1].c as qual_milli
from (select *, list_sort([g0, g1, g2]) as gs from gap_scores) where gs[1].g <> '0/0'""",
    "normalised_concordance": """
select cast(count(*) as bigint) as total, cast(count(f.pos) as bigint) as matches, cast(count(*) - count(f.pos) as bigint) as diff
from (select * from spelled_keys where l_linestatus = 'O') o left join (select * from spelled_keys where l_linestatus = 'F') f
 on o.ref_idx = f.ref_idx and o.pos = f.pos and o.ref = f.ref and o.alt = f.alt""",
    "chained_seeds": """
select item_id, doc_id, e.f as score, e.y - e.x as diag from item_ends where e.f >= 30
qualify row_number() over (partition by item_id, doc_id order by e.f desc, e.y, e.x) = 1""",
    "placed_singly": f"""
select {_PAIR}, mate, cast(coalesce(place.ref_idx, -1) as int) as ref_idx, case when place is null then 0 else greatest(place.loc, 1) end as pos,
 case when place is null then 4 when place.neg then 16 else 0 end as flag,
 case when place is null then '*' when place.loc < 1 then concat(1 - place.loc, 'S', 63 + place.loc, 'M') else '64M' end as cigar, place.votes as votes
from pair_ends left join end_alone using (seq)""",
    "placed_pairs": f"""
select {_PAIR}, mate, coalesce(own.ref_idx, -1) as ref_idx, case when own is null then 0 else greatest(own.loc, 1) end as pos,
 cast(case when paired then 1 else 0 end + case when proper then 2 else 0 end + case when own is null then 4 else 0 end
  + case when paired and other is null then 8 else 0 end + case when own.neg then 16 else 0 end + case when other.neg then 32 else 0 end
  + case when paired then case when mate = 1 then 64 else 128 end else 0 end as int) as flag,
 case when own is not null and (proper or sole) then 60 else 0 end as mapq,
 case when own is null then '*' when own.loc < 1 then concat(1 - own.loc, 'S', 63 + own.loc, 'M') else '64M' end as cigar,
 coalesce(other.ref_idx, -1) as mate_ref, case when other is null then 0 else greatest(other.loc, 1) end as mate_pos,
 case when own.ref_idx = other.ref_idx then cast((greatest(own.loc, other.loc) + 63 - least(greatest(own.loc, 1), greatest(other.loc, 1)) + 1)
  * case when greatest(own.loc, 1) < greatest(other.loc, 1) or (greatest(own.loc, 1) = greatest(other.loc, 1) and mate = 1) then 1 else -1 end as int)
  else 0 end as tlen, own.votes as votes
from (select e.*, q1 is not null and q2 is not null as paired, coalesce(f.proper, false) as proper,
  case when f.q1 is not null then case when e.mate = 1 then f.a else f.b end else z.place end as own,
  case when f.q1 is not null then case when e.mate = 1 then f.b else f.a end end as other,
  coalesce(z.sole, false) as sole
 from (select *, max(seq) filter (mate = 1) over (partition by ok, ln, pk, sk) as s1, max(seq) filter (mate = 2) over (partition by ok, ln, pk, sk) as s2
  from pair_ends) e left join end_final f on f.q1 = s1 and f.q2 = s2 left join end_alone z on z.seq = e.seq)""",
    "pair_duplicates": f"select {_ID}, is_dup, case when is_dup then equal_of end as dup_of from end_marks",
    "pair_metrics": """
select lib, pairs, pair_dups, pair_optical, single, single_dups, case when c > 0 and n > c then cast(round(c * (r.lo + r.hi) / 2) as bigint) end as library_size
from (select *, list_reduce([{'lo': 1.0::double, 'hi': high}] || list_transform(range(40), lambda i: {'lo': 0.0::double, 'hi': 0.0::double}),
  lambda r, _: case when 1 / ((r.lo + r.hi) / 2) - 1 + exp(-n / ((r.lo + r.hi) / 2 * c)) > 0
   then {'lo': (r.lo + r.hi) / 2, 'hi': r.hi} else {'lo': r.lo, 'hi': (r.lo + r.hi) / 2} end) as r
 from (select *, list_reduce(list_transform(range(13), lambda i: 100.0::double), lambda h, _: case when 1 / h - 1 + exp(-n / (h * c)) > 0 then h * 10 else h end) as high
  from (select *, (pairs - pair_optical)::double as n, (pairs - pair_dups)::double as c from fragment_counts)))""",
    "contig_dict": "select ref_idx, contig, length from contigs",
    "sam_scan": """
select case when ok then id end as qname, case when ok then cast(f as int) end as flag, case when ok then coalesce(i, -1) else -1 end as ref_idx,
 case when ok then pos end as pos, case when ok then mapq end as mapq, case when ok then cigar end as cigar, case when ok then s end as seq,
 case when ok then cast(20*(20-length(replace(ql,'5',''))) + 32*(20-length(replace(ql,'A',''))) + 40*(20-length(replace(ql,'I',''))) as int) end as sum_q,
 case when ok then concat('RG:Z:', chunk) end as tag, ok as whole,
 case when not ok then concat_ws(chr(9), id, case when l_orderkey % 11 = 0 then 'x' else f end, case when l_orderkey % 13 <> 0 then
  concat_ws(chr(9), coalesce(contig,'*'), cast(pos as varchar), cast(mapq as varchar), cigar, '*', '0', '0', s, ql) end, concat('RG:Z:', chunk), 'NM:i:0') end as corrupt
from (select reads.*, contigs.contig, contigs.ref_idx as i, concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey) as id,
 l_orderkey % 11 <> 0 and l_orderkey % 13 <> 0 as ok, cast((case when reads.ref_idx < 0 then 4 else 0 end) + (case when neg then 16 else 0 end) as varchar) as f,
 translate(to_base(l_partkey, 4, 20), '0123', 'ACGT') as s, translate(to_base(l_orderkey, 4, 20), '0123', '!5AI') as ql
 from reads left join contigs on contigs.ref_idx = reads.ref_idx)""",
    "fastq_scan": """
select concat(id, '/', mate) as name, cast(mate as int) as mate, case mate when 1 then seq else reverse(seq) end as seq, repeat('@', 20) as qual
from (select concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey) as id,
 translate(to_base(l_partkey, 4, 20), '0123', 'ACGT') as seq, unnest([1, 2]) as mate from lineitem)""",
    "bed_scan": """
select contig, start0, end0, concat('part', p_partkey, chr(9), '0') as rest from targets join contigs on contigs.ref_idx = targets.ref_idx""",
    "vcf_scan": """
select concat('chr', c) as contig, cast(p + 1 as int) as pos, '.' as id, r as ref, v as alt, cast(50 as double) as qual, 'PASS' as filter, 'DP=8' as info,
 concat_ws(chr(9), concat('chr', c), cast(p + 1 as varchar), '.', r, v, '50', 'PASS', 'DP=8') as line from truth""",
    "fasta_scan": """
select contig, cast(c*256 + 1 as int) as chunk_start, substring(b, c*256 + 1, 272) as bases
from (select contig, b, unnest(range(0, (length(b)+255)//256)) as c
 from (select concat('d', doc_id) as contig, translate(lower(hex(text)), '0123456789', 'ghijklmnop') as b from documents))""",
}


def _needed(sql: str) -> list[str]:
    found: set[str] = set()
    for name in reversed(VIEWS):
        used = [sql, *(VIEWS[v] for v in found)]
        if any(re.search(rf"\b(?:from|join)\s+{name}\b", text) for text in used):
            found.add(name)
    return [name for name in VIEWS if name in found]


def oracle() -> dict[str, str]:
    out = {}
    for key, sql in QUERIES.items():
        views = ", ".join(f"{name} as ({VIEWS[name]})" for name in _needed(sql))
        out[key] = f"with {views} {sql.strip()}" if views else sql.strip()
    return out
