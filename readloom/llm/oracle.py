"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

import string

LOWER = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def ranked_search(top: int = 10) -> str:
    terms = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
with rows as (select doc_id, row_number() over () as doc, {terms} as terms from documents),
sized as (select doc_id, doc, terms, len(terms) as n from rows where len(terms) > 0),
total as (select count(*)::bigint as all_docs, sum(n)::bigint as all_terms from sized),
asked as (select distinct item_id, unnest({terms}) as term from benchmark),
postings as (
  select doc, doc_id, n, term, count(*)::bigint as tf from (select doc, doc_id, n, unnest(terms) as term from sized)
  where term in (select term from asked) group by all
),
weights as (
  select term, floor(1000 * ln((2 * all_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from postings, total group by term, all_docs
),
scores as (
  select item_id, doc, any_value(doc_id) as doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * all_docs) // all_terms))))::bigint as score
  from asked join weights using (term) join postings using (term), total group by item_id, doc
),
ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last)::int as rank, doc_id, score
  from scores where score > 0
)
select * from ranked where rank <= {top}"""


def merkle(levels: int = 6, source_levels: int = 4) -> str:
    """Unrolled: up to 16 ** levels rows in a source."""
    shown = lambda c: f"coalesce(strlen(({c})::varchar)::varchar || ':' || ({c})::varchar, '-')"
    leaf = lambda text: "sha256(" + " || ".join(map(shown, ["doc_id", "source", "lang", "n_chars", text])) + ")"
    steps = []
    for k in range(levels + source_levels):
        if k == levels:
            steps.append(f"""
n{k} as (select '' as tree, row_number() over (order by tree) - 1 as place, digest, tree as name from top),
f{k} as (
  select doc, doc_id, '' as tree, s.place, folded, proof, leaf, s.digest as subroot
  from g{k} join n{k} s on g{k}.tree = s.name
)""")
        runs = f"""
r{k} as (
  select tree, place // 16 as run, list(digest order by place) as nodes, any_value(size) as size
  from (select tree, place, digest, count(*) over (partition by tree) as size from n{k}) group by tree, place // 16
)"""
        last = k in (levels - 1, levels + source_levels - 1)
        n, f = ("top" if last else f"n{k + 1}"), (f"g{k + 1}" if last else f"f{k + 1}")
        if k == levels + source_levels - 1:
            n = "root"
        steps.append(f"""{runs},
{n} as (
  select tree, run as place, case when size > 1 then sha256(array_to_string(nodes, '')) else nodes[1] end as digest from r{k}
),
{f} as (
  select doc, doc_id, f.tree, run as place, leaf, subroot,
         case when size > 1 then sha256(
           array_to_string(nodes[1 : place % 16], '') || folded || array_to_string(nodes[place % 16 + 2 :], '')
         ) else folded end as folded,
         proof || case when size > 1 then
           array_to_string(nodes[1 : place % 16], '') || array_to_string(nodes[place % 16 + 2 :], '') else '' end as proof
  from f{k} f join r{k} r on f.tree = r.tree and f.place // 16 = r.run
)""")
    return f"""
with bytes as (select list(c order by i) as crc from (
  select i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: case when (c & 1) = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
  from (select unnest(range(256)) as i)
)),
rows as (
  select doc_id, coalesce('+' || source, '') as tree, {leaf("text")} as leaf, {leaf(LOWER)} as lowered,
         xor(4294967295, list_reduce(
           [4294967295] || list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint),
           lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])
         )) % 5 = 0 as tampered
  from documents, bytes
),
leaves as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as place,
         row_number() over () as doc from rows
),
n0 as (select tree, place, leaf as digest from leaves),
f0 as (
  select doc, doc_id, tree, place, case when tampered then lowered else leaf end as folded, '' as proof, leaf,
         null::varchar as subroot from leaves
),{",".join(steps)}
select doc_id, leaf, subroot, digest as root, sha256(proof) as proof_sha256, folded as folded_root, folded = digest as verified
from g{levels + source_levels}, (select digest from root)"""
