"""DuckDB SQL of the manifest and vector queries, written out level by level and round by round."""

from __future__ import annotations


def _said(col: str) -> str:
    return f"coalesce(cast(strlen(cast({col} as varchar)) as varchar) || ':' || cast({col} as varchar), '-')"


def merkle_sql(levels: int = 24, top_levels: int = 8) -> str:
    """Manifest of ``documents``: trees of up to ``2**levels`` leaves, up to ``2**top_levels`` languages."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    leaf = " || ".join(map(_said, fields))
    shown = " || ".join(_said("(n_chars + 1)" if f == "n_chars" else f) for f in fields)
    out = [f"""
crc as (select range as b from range(256)),
step as (select b, list_reduce(list_prepend(cast(b as bigint), range(8)),
                   lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as r from crc),
lookup as (select list(r order by b) as t from step),
l as (select doc_id, lang, sha256({leaf}) as leaf, sha256({shown}) as other,
             xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(cast(doc_id as varchar)) + 1),
                   lambda k: cast(ord(substr(cast(doc_id as varchar), k, 1)) as bigint))),
                 lambda c, x: xor(c >> 8, t[xor(c, x) % 256 + 1])), 4294967295) % 7 = 0 as tampered
      from documents cross join lookup),
p as (select *, case when tampered then other else leaf end as f0,
             row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos,
             dense_rank() over (order by coalesce('=' || lang, '')) - 1 as tree from l),
n0 as (select tree, pos as i, leaf as h from p)"""]

    def climb(name: str, key: str, top: int) -> None:
        for k in range(top):
            out.append(f"{name}{k + 1} as (select {key} as {key.split()[-1]}, i // 2 as i, case when max(m) = 1 then any_value(h) else "
                       f"sha256(string_agg(h, '' order by i)) end as h from (select *, count(*) over "
                       f"(partition by {key}) as m from {name}{k}) group by {key}, i // 2)")
    climb("n", "tree", levels)
    out.append(f"t0 as (select 0 as all_, tree as i, h from n{levels})")
    climb("t", "all_", top_levels)
    out.append(f"q0 as (select p.doc_id, p.lang, p.leaf, p.f0 as f, p.pos, p.tree, '' as proof, n{levels}.h as subroot, "
               f"t{top_levels}.h as root from p join n{levels} on p.tree = n{levels}.tree cross join t{top_levels})")
    at = 0
    for name, pos, match, top in (("n", "pos", "s.tree = q.tree and", levels), ("t", "tree", "", top_levels)):
        for k in range(top):
            size = f"(select {'tree, ' if name == 'n' else ''}count(*) as m from {name}{k} {'group by tree' if name == 'n' else ''})"
            join = f"join {size} z on z.tree = q.tree" if name == "n" else f"cross join {size} z"
            bit = f"(q.{pos} >> {k}) % 2"
            out.append(
                f"q{at + 1} as (select q.doc_id, q.lang, q.leaf, case when z.m = 1 then q.f when s.h is null then sha256(q.f) "
                f"when {bit} = 1 then sha256(s.h || q.f) else sha256(q.f || s.h) end as f, q.pos, q.tree, "
                f"q.proof || coalesce(s.h, '') as proof, q.subroot, q.root from q{at} q {join} left join {name}{k} s "
                f"on {match} z.m > 1 and s.i = xor(q.{pos} >> {k}, 1))")
            at += 1
    return ("with " + ",\n".join(f"{x.strip()}" for x in out)
            + f"\nselect doc_id, lang, leaf, subroot, root, sha256(proof) as proof_sha256, f as folded_root, f = root as verified from q{at}")


def part_codes_sql(width: int = 64, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Codes of ``embeddings`` of length ``width``."""
    w = width // parts
    out = [f"""kept as (select vec_id, label, list_transform(embedding, lambda x: cast(floor({scale} * cast(x as double)) as bigint)) as v
 from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
pt as materialized (select vec_id, part, v[part * {w} + 1:part * {w} + {w}] as x from kept, range({parts}) r(part)),
b0 as materialized (select part, row_number() over (partition by part order by vec_id) - 1 as entry, x as c from pt
 qualify row_number() over (partition by part order by vec_id) <= {entries})"""]
    gap = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for k in range(rounds + 1):
        out.append(f"a{k} as materialized (select vec_id, part, x, arg_min(entry, d * 256 + entry) as entry, cast(min(d) as bigint) as d "
                   f"from (select pt.vec_id, pt.part, pt.x, b.entry, {gap} as d from pt join b{k} b on pt.part = b.part) "
                   f"group by vec_id, part, x)")
        if k < rounds:
            means = ", ".join(f"cast(floor(sum(x[{j + 1}]) / count(*)) as bigint)" for j in range(w))
            out.append(f"b{k + 1} as materialized (select b.part, b.entry, coalesce(m.c, b.c) as c from b{k} b left join "
                       f"(select part, entry, [{means}] as c from a{k} group by part, entry) m "
                       f"on b.part = m.part and b.entry = m.entry)")
    return "with " + ",\n".join(out) + f""",
e as (select vec_id, string_agg(printf('%02x', entry), '' order by part) as code, cast(sum(d) as bigint) as error
 from a{rounds} group by vec_id),
s as (select sha256(string_agg(array_to_string(c, ','), ',' order by part, entry)) as codebooks_sha256 from b{rounds})
select e.vec_id, e.code, e.error, cast(sum(e.error) over (partition by k.label) as bigint) as label_error, s.codebooks_sha256
from e join kept k on e.vec_id = k.vec_id cross join s"""


VECTOR_LINKS_SQL = """
with recursive u as (
  select vec_id, list_transform(embedding, lambda x: cast(x as double)) as v,
         embedding is not null and len(embedding) > 0
           and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
           and len(list_filter(embedding, lambda x: x <> 0)) > 0 as good
  from embeddings),
pairs as (
  select a.vec_id as a, b.vec_id as b from u a join u b on a.vec_id < b.vec_id
  where a.good and b.good and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.9),
links as (select a, b from pairs union all select b, a from pairs),
reach as (
  select vec_id, vec_id as other from u
  union
  select r.vec_id, l.b from reach r join links l on r.other = l.a),
low as (select vec_id, min(other) as component_id from reach group by vec_id),
n as (select a, count(*) as n_links from links group by a)
select low.vec_id, coalesce(n.n_links, 0) as n_links, low.component_id, low.vec_id = low.component_id as kept
from low left join n on low.vec_id = n.a
"""
