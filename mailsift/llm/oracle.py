"""DuckDB SQL for the operator queries that SQL can express."""

_WORD = r"[^ \t\n\x0b\f\r]+"

_OP6 = f"""
with sized as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) as bigint) size,
         cast(('0x' || substr(md5(coalesce(text, '')), 1, 8)) as bigint) th
  from documents),
named as (
  select source, sum(size) source_size,
         row_number() over (order by source nulls last) - 1 pos from sized group by source),
weighed as (
  select source, cast(source_size as bigint) source_size,
         case pos % 3 when 0 then 3 when 1 then 1 else 2 end weight,
         cast(source_size as double) * 2.0 cap from named),
levels as (
  select *, (cast((select sum(size) from sized) as double) * 1.5
      - coalesce(sum(cap) over (order by cap / weight, source nulls last
                                rows between unbounded preceding and 1 preceding), 0.0))
    / sum(weight) over (order by cap / weight, source nulls last
                        rows between current row and unbounded following) lev from weighed),
targets as (
  select source, source_size, least(cap, weight * (select max(lev) from levels)) target,
         cast(('0x' || substr(md5('mix-offset:' || coalesce(source, '')), 1, 8)) as bigint)
           / 4294967296.0::double u from levels),
hashed as (
  select *, cast(('0x' || substr(md5('mix:' || coalesce(cast(doc_id as varchar), '')), 1, 8))
                 as bigint) h,
         greatest(1, cast(ceil((select count(*) from sized) / 100000.0) as bigint)) slices
  from sized),
placed as (
  select *, row_number() over (partition by source
    order by floor(log2(size + 1) * 16), (h + th) % slices, size, h, doc_id nulls first, th) p
  from hashed),
rated as (
  select d.doc_id, d.size, t.source_size, t.target, d.p, t.u,
         case when t.source_size > 0 then t.target / t.source_size else 0.0 end r
  from placed d join targets t on d.source is not distinct from t.source)
select doc_id, size, source_size, target,
       cast(least(2, floor(p * r + u) - floor((p - 1) * r + u)) as bigint) * size taken
from rated
"""

_OP7 = f"""
with words as (
  select doc_id, lang, source, text, row_number() over () rid,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') w from documents),
spots as (
  select rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] g
  from words, unnest(range(1, len(w) - 1)) r(i)),
again as (
  select rid, i from (select rid, i, count(*) over (partition by rid, g) c from spots) where c > 1),
covered as (
  select rid, count(distinct i + k) n from again, unnest([0, 1, 2]) o(k) group by rid),
lined as (
  select rid, cast(count(*) as bigint) n_lines, count(*) - count(distinct l) n_dup_lines
  from (select rid, unnest(string_split(text, chr(10))) l from words)
  where regexp_matches(l, '{_WORD}') group by rid),
counted as (
  select doc_id, lang, source, cast(len(w) as bigint) n_words,
         cast(coalesce(length(array_to_string(w, '')), 0) as bigint) word_chars,
         cast(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) as bigint) n_symbols,
         cast(coalesce(n_dup_lines, 0) as bigint) n_dup_lines,
         cast(coalesce(covered.n, 0) as bigint) n_repeat_words,
         coalesce(n_lines, 0) n_lines
  from words left join covered using (rid) left join lined using (rid)),
judged as (
  select *, (n_words < 50 or 100 * n_repeat_words > 50 * n_words) base_failed,
         case when word_chars > 0 then n_symbols / word_chars else 0.0 end symbols,
         case when n_lines > 0 then n_dup_lines / n_lines else 0.0 end dup_lines,
         case when n_words > 0 then n_repeat_words / n_words else 0.0 end repeats,
         case when n_words > 0 then word_chars / n_words else 0.0 end word_len
  from counted),
vals as (
  unpivot (select lang, source, symbols, dup_lines, repeats, word_len from judged
           where not base_failed)
  on symbols, dup_lines, repeats, word_len into name ratio value v),
sketch as (
  select lang, source, ratio, case when v > 0 then ceil(ln(v) / ln(1.02::double)) end b, count(*) n
  from vals group by all),
run as (
  select *, sum(n) over (partition by lang, source, ratio order by b nulls first
                         rows unbounded preceding) upto,
         sum(n) over (partition by lang, source, ratio) total,
         case when b is null then 0.0 else pow(1.02::double, b) end v from sketch),
q as (
  select lang, source, ratio, max(total) n, min(v) filter (upto >= ceil(total * 0.25)) q25,
         min(v) filter (upto >= ceil(total * 0.5)) q50, min(v) filter (upto >= ceil(total * 0.75)) q75,
         min(v) filter (upto >= ceil(total * 0.95)) q95 from run group by all),
cuts as (
  select lang, source,
    max(q50 + greatest(6 * abs(q50 - q75), 0.05)) filter (ratio = 'symbols') c1,
    max(q95 + greatest(4 * abs(q95 - q75), case when n < 20 then 0.35 else 0.25 end))
      filter (ratio = 'dup_lines') c2,
    max(q95 + greatest(4 * abs(q95 - q75), case when n < 20 then 0.35 else 0.2 end))
      filter (ratio = 'repeats') c3,
    max(q50 + greatest(8 * abs(q50 - q75), case when n < 20 then 3.0 else 0.4 end))
      filter (ratio = 'word_len') c4,
    max(q50 - greatest(8 * abs(q50 - q25), case when n < 20 then 2.0 else 0.4 end))
      filter (ratio = 'word_len') c5
  from q group by all)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not coalesce(symbols > c1, false) and not coalesce(dup_lines > c2, false)
         and not coalesce(repeats > c3, false) and not coalesce(word_len > c4, false)
         and not coalesce(word_len < c5, false) kept
from judged j left join cuts c
  on j.lang is not distinct from c.lang and j.source is not distinct from c.source
"""

_CONTROL = r"(\|im_start\|>|\|im_sep\|>|\|im_end\|>|s>|/s>|<SYS>>|</SYS>>)"
_ESC = (r"regexp_replace(regexp_replace(replace({0}, '\', '\\'), '<" + _CONTROL + r"', '<\\\1', 'g'),"
        r" '\[(INST\]|/INST\])', '[\\\1', 'g')")
_OP2 = f"""
with said as (
  select conv_id, turn, coalesce(role, '') r, coalesce(text, '') t from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
walked as (
  select *, row_number() over (partition by conv_id order by turn nulls first, r, t) - 1 k,
         lag(r) over (partition by conv_id order by turn nulls first, r, t) before,
         length({_ESC.format('r')}) + length({_ESC.format('t')}) + 33 chars from said),
judged as (
  select *, not coalesce(case r when 'system' then before is null
      when 'user' then before is null or before in ('system', 'assistant')
      when 'assistant' then before = 'user' else false end, false) wrong from walked)
select conv_id, count(*) n_turns,
       sha256(string_agg(r || chr(10) || t || chr(10), '' order by k)) turns_sha256,
       cast(sum(case when r = 'assistant' then length(t) else 0 end) as bigint) loss_chars,
       sha256(coalesce(string_agg(t, '' order by k) filter (r = 'assistant'), '')) loss_sha256,
       cast(sum(chars) as bigint) formatted_chars,
       not bool_or(wrong) and arg_max(r, k) = 'assistant' valid_order,
       cast(min(k) filter (wrong) as bigint) bad_turn
from judged group by conv_id
"""


def _op13_round(k: int) -> str:
    """The codebooks ``b<k+1>`` after one round over the codebooks ``b<k>``."""
    return f"""
a{k} as materialized (
  select x.id, x.p, min(struct_pack(d := x.norm + b.norm - 2 * list_inner_product(x.x, b.x),
                                    e := b.e)) best
  from cuts x join b{k} b using (p) group by x.id, x.p),
m{k} as (
  select p, best.e e, j, count(*) n, sum(cast(x[j + 1] as hugeint)) s
  from a{k} join cuts using (id, p), range((select w from shape)) js(j) group by p, best.e, j),
b{k + 1} as materialized (
  select p, e, x, list_inner_product(x, x) norm from (
    select b.p, b.e, list(coalesce(cast((s - ((s % n) + n) % n) // n as double), b.x[q.j + 1])
                          order by q.j) x
    from b{k} b cross join (select unnest(range((select w from shape))) j) q
    left join m{k} m on m.p = b.p and m.e = b.e and m.j = q.j group by b.p, b.e))"""


_OP13 = f"""
with kept as materialized (
  select vec_id, label, row_number() over (order by vec_id nulls last, embedding) id,
         list_transform(embedding, lambda x: floor(256 * cast(x as double))) v
  from embeddings where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
shape as (select max(len(v)) // 16 w from kept),
cuts as materialized (
  select *, list_inner_product(x, x) norm from (
    select id, p, v[p * w + 1:(p + 1) * w] x from kept, shape, range(16) ps(p))),
b0 as materialized (select p, id - 1 e, x, norm from cuts where id <= 64),
{_op13_round(0)}, {_op13_round(1)},
a2 as materialized (
  select x.id, x.p, min(struct_pack(d := x.norm + b.norm - 2 * list_inner_product(x.x, b.x),
                                    e := b.e)) best
  from cuts x join b2 b using (p) group by x.id, x.p),
coded as (
  select id, string_agg(printf('%02x', best.e), '' order by p) code,
         cast(sum(best.d) as bigint) error from a2 group by id),
books as (
  select sha256(string_agg(list_aggregate(list_transform(x, lambda c: cast(cast(c as bigint) as varchar)),
                                          'string_agg', ','), ',' order by p, e)) digest from b2)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) label_error,
       (select digest from books) codebooks_sha256
from kept join coded using (id)
"""


def _edit(state: str, cost: str, initial: str, line: str) -> str:
    return (f"struct_pack(c := {state}.c + {cost}, a := {state}.a || '{initial}', "
            f"o := {state}.o || {line})")


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _closed(s0: str, s1: str, s2: str, s3: str) -> str:
    """The four states (columns) after inserting what is due."""
    user, said = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    return f"""select conv_id, k, s0, s1, t2 s2, {_least('s3', _edit('t2', '2', 'I', said))} s3 from (
      select *, {_least('s2', *[_edit(s, '2', 'I', user) for s in ('s0', 's1', 's3')])} t2
      from (select conv_id, k, {s0} s0, {s1} s1, {s2} s2, {s3} s3 from #))"""


_NEVER = "struct_pack(c := 1000000000, a := '', o := '')"
_DROP = lambda s: _edit(s, "3", "D", "''")
_KEEP = lambda s, initial: (
    f"case when stays and initial = '{initial}' then "
    + _edit(s, "extra", "K", "chr(10) || role || ':' || text") + f" else {_NEVER} end")
_REROLE = lambda s, role: (
    "case when stays then " + _edit(s, "(2 + extra)", "R", f"chr(10) || '{role}:' || text")
    + f" else {_NEVER} end")
_ROW = _closed(
    _DROP("s0"), _least(_DROP("s1"), _KEEP("s0", "s")),
    _least(_DROP("s2"), *[f(s, x) for s in ("s0", "s1", "s3") for f, x in ((_KEEP, "u"), (_REROLE, "user"))]),
    _least(_DROP("s3"), _KEEP("s2", "a"), _REROLE("s2", "assistant")))
_BEGIN = _closed("struct_pack(c := 0, a := '', o := '')", *[_NEVER] * 3)
_CRC32 = ("xor(list_reduce(list_transform(string_split({0}, ''), lambda x: cast(ord(x) as bigint)), "
          "lambda acc, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: "
          "case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, xor(acc, b)), "
          "4294967295), 4294967295)")
_OP11 = f"""
with recursive hit as materialized (
  select *, {_CRC32.format("coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')")} % 20 d
  from conversations),
damaged as (
  select conv_id, turn, case when d = 4 then 'user' else coalesce(role, ' ') end as "role",
         case d when 1 then '' when 2 then regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g')
           else coalesce(text, ' ') end as "text", unnest(range(case d when 3 then 2 else 1 end)) copy
  from hit where d <> 0),
lined as (
  select *, row_number() over (partition by conv_id
              order by turn nulls first, "role", left("text", 64), md5("text"), copy) - 1 k,
         case when left("role", 1) in ('s', 'u', 'a') then left("role", 1) else 'x' end initial,
         rtrim("text", ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) bare
  from damaged),
judged as materialized (
  select *, case when bare = '' then 'blank'
      when row_number() over (partition by conv_id, "role", "text" order by k) > 1 then 'duplicate'
      when right(bare, 1) not in ('.', '!', '?') then 'truncated' end fault,
    coalesce(lag(initial) over (partition by conv_id order by k) || initial
             not in ('su', 'ua', 'au'), false) illegal
  from lined),
coded as materialized (
  select conv_id, k, "role", "text", initial, coalesce(fault, '') not in ('blank', 'duplicate') stays,
         case when fault = 'truncated' then 1 else 0 end extra from judged),
counts as (
  select conv_id, cast(coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as bigint) gaps,
         count(*) filter (fault = 'blank') blank, count(*) filter (fault = 'duplicate') duplicate,
         count(*) filter (fault = 'truncated') truncated, count(*) filter (illegal) illegal,
         count(*) n from judged group by conv_id),
walk as (
  ({_BEGIN.replace('#', '(select conv_id, cast(0 as bigint) k from counts)')})
  union all
  ({_ROW.replace('#', "(select w.conv_id, w.k + 1 k, s0, s1, s2, s3, role, text, initial, stays, extra"
                      " from walk w join coded r on r.conv_id is not distinct from w.conv_id and r.k = w.k)")})),
done as (
  select w.conv_id, {_least('s0', 's3')} best from walk w join counts c
    on c.conv_id is not distinct from w.conv_id and c.n = w.k)
select i.conv_id, coalesce(gaps, 0) gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate,
       coalesce(truncated, 0) truncated, coalesce(illegal, 0) illegal,
       cast(coalesce(best.c, 0) as bigint) "cost", coalesce(best.a, '') audit,
       sha256(coalesce(substr(best.o, 2), '')) repaired_sha256
from (select distinct conv_id from conversations) i
left join counts c on c.conv_id is not distinct from i.conv_id
left join done d on d.conv_id is not distinct from i.conv_id
"""


_OP12 = """
with docs as materialized (
  select row_number() over () rid, doc_id, coalesce(doc_id, 9223372036854775807) own,
         hex(encode(coalesce(text, ''))) h from documents),
windows as (
  select rid, own, a, substr(h, 2 * a + 1, 100) s
  from (select rid, own, h, unnest(range(greatest(0, len(h) // 2 - 49))) a from docs)),
lows as (select s, min(own) low from windows group by s having min(own) < max(own)),
hits as (select rid, a from windows join lows using (s) where low < own),
lined as (
  select rid, a, case when a <= lag(a) over (partition by rid order by a) + 50 then 0 else 1 end fresh
  from hits),
spans as materialized (
  select rid, min(a) s, max(a) + 50 e
  from (select rid, a, sum(fresh) over (partition by rid order by a) island from lined)
  group by rid, island),
pieces as (
  select rid, coalesce(lag(e) over (partition by rid order by s), 0) f, s t from spans
  union all select rid, max(e), 1000000000 from spans group by rid),
kept as (
  select rid, string_agg(substr(h, 2 * f + 1, 2 * (t - f)), '' order by f) h
  from pieces join docs using (rid) group by rid),
counts as (select rid, sum(e - s) n_removed, count(*) n_spans from spans group by rid)
select doc_id, cast(len(docs.h) // 2 as bigint) n_bytes, cast(coalesce(n_removed, 0) as bigint) n_removed,
       coalesce(n_spans, 0) n_spans, sha256(unhex(coalesce(kept.h, docs.h))) kept_sha256
from docs left join counts using (rid) left join kept using (rid)
"""

ORACLE_SQL = {"op2_chat": _OP2, "op6_mixing": _OP6, "op7_quality": _OP7,
              "op11_repair": _OP11, "op12_repeats": _OP12,
              "op13_slices": _OP13}
