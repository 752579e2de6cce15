"""SQL counterpart of the conversation repair: one pass from the last turn to the first, all states at once."""

CRC_SQL = """
bits as (select list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, z: xor(c >> 1, (c & 1) * 3988292384))) as crc),
"""


def state_sql(state: int, forms: list[str]) -> str:
    """The best (cost, audit, text) in ``state`` with no turn, one or two turns inserted before the row."""
    after = [2, 2, 3, 2]
    says = {2: "user", 3: "assistant"}
    ways, now, paid, edits, text = [], state, 0, "", ""
    for _ in range(3):
        for way in forms:
            speaker = after[now]
            role, kinds = says[speaker], {"s": (1, now == 0), "u": (2, speaker == 2), "a": (3, speaker == 3)}
            if way == "D":
                ways.append(f"struct_pack(c := {paid} + 4 + b[{now + 1}].c, e := '{edits}D' || b[{now + 1}].e, t := '{text}' || b[{now + 1}].t)")
            elif way == "R":
                ways.append(
                    f"case when fault in ('', 'truncated') then struct_pack(c := {paid} + 3 + extra + b[{speaker + 1}].c, "
                    f"e := '{edits}R' || b[{speaker + 1}].e, t := '{text}' || chr(10) || '{role}:' || text || b[{speaker + 1}].t) end"
                )
            else:
                for initial, (last, legal) in kinds.items():
                    if legal:
                        ways.append(
                            f"case when fault in ('', 'truncated') and role[1] = '{initial}' then struct_pack(c := {paid} + extra + b[{last + 1}].c, "
                            f"e := '{edits}K' || b[{last + 1}].e, t := '{text}' || chr(10) || role || ':' || text || b[{last + 1}].t) end"
                        )
        now, paid, edits = after[now], paid + 3, edits + "I"
        text += "' || chr(10) || '" + says[now] + ":"
    return f"list_min(list_filter([{', '.join(ways)}], lambda x: x is not null))"


REPAIR_SQL = (
    "with recursive"
    + CRC_SQL
    + r"""
keyed as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
  coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations),
hashed as (select keyed.*, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(k) + 1), lambda i: ascii(k[i]))),
  lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 20 as way from keyed, bits),
hurt as (select conv_id, turn, case way when 4 then 'user' else role end as role, case way when 1 then ''
  when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(case way when 3 then [0, 1] else [0] end) as copy
  from hashed where way <> 0),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as n from hurt),
told as (select *, regexp_replace(text, '[\x20\x09-\x0D]+$', '') as trimmed,
  row_number() over (partition by conv_id, role, text order by n) as nth, lag(role[1]) over (partition by conv_id order by n) || role[1] as pair from placed),
judged as (select *, case when trimmed = '' then 'blank' when nth > 1 then 'duplicate'
  when trimmed[-1] not in ('.', '!', '?') then 'truncated' else '' end as fault from told),
ready as (select *, case fault when 'truncated' then 3 else 0 end as extra from judged),
figures as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
  count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
  count(*) filter (pair not in ('su', 'ua', 'au')) as illegal, max(n) as n_rows from ready group by conv_id),
walk(conv_id, n, b) as (
  select conv_id, n_rows, [struct_pack(c := 0, e := '', t := ''),
    struct_pack(c := 6, e := 'II', t := chr(10) || 'user:' || chr(10) || 'assistant:'),
    struct_pack(c := 3, e := 'I', t := chr(10) || 'assistant:'), struct_pack(c := 0, e := '', t := '')] from figures
  union all
  select walk.conv_id, walk.n - 1, ["""
    + ", ".join(state_sql(s, ["D", "R", "K"]) for s in range(4))
    + r"""]
  from walk join ready on ready.conv_id is not distinct from walk.conv_id and ready.n = walk.n)
select all_convs.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(b[1].c, 0)::bigint as cost, coalesce(b[1].e, '') as audit,
  sha256(coalesce(b[1].t[2:], '')) as repaired_sha256, coalesce(n_rows, 0) as n_rows
from (select distinct conv_id from conversations) as all_convs
left join figures on figures.conv_id is not distinct from all_convs.conv_id
left join walk on walk.conv_id is not distinct from all_convs.conv_id and walk.n = 0
"""
)
