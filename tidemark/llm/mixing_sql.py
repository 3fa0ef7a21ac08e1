"""The SQL, for DuckDB, that mixes the rows of a table as ``mixing.mix`` does."""

from __future__ import annotations

from tidemark.llm.mixing import GRID, MOST_BLOCKS


def mixing_sql(table: str, max_repeats: float, block_tokens: int, seed: int) -> str:
    """Rows ``doc_id, source, n_tokens, epoch, block, position``; the exponent is found by trying all."""
    return f"""
with d as (
  select doc_id, source, case when source is null then 'null' else '=' || source end as key,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as n_tokens,
         ('0x' || substr(md5('{seed}|' || coalesce(doc_id::varchar, md5(coalesce(text, '')))), 1, 8))::bigint as hash
  from {table}),
total as (select greatest({block_tokens}, ceil(sum(n_tokens) / {MOST_BLOCKS})) as size, sum(n_tokens) as all_tokens from d),
source as (select key, sum(n_tokens)::bigint as tokens from d group by key),
share as (select *, tokens::double / (select all_tokens from total) as p,
          greatest(ceil(tokens / (select size from total)), 1)::bigint as n_blocks from source),
exponent as (
  select min(k) / {GRID}.0::double as a from range({GRID} + 1) t(k),
         (select min(p) / max(p) as least from share where tokens > 0)
  where pow(least, k / {GRID}.0::double - 1) <= {max_repeats}),
raw as (select *, case when tokens > 0 then pow(p, a) else 0 end as power from share, exponent),
budget as (select key, tokens, n_blocks, power * (select max(tokens / power) from raw where tokens > 0) as budget from raw),
blocks as (
  select d.key, d.hash % b.n_blocks as block, sum(n_tokens)::bigint as block_tokens
  from d join budget b using (key) group by all),
epochs as (
  select key, tokens, budget, unnest(range(greatest(ceil(coalesce(budget / nullif(tokens, 0), 0) - 1e-9), 1)::bigint)) as epoch
  from budget),
placed as (
  select key, block, epoch, budget, epoch * tokens + block_tokens / 2.0::double + coalesce(sum(block_tokens) over (
           partition by key, epoch order by md5('{seed}|' || epoch || '|' || key || '|' || block)
           rows between unbounded preceding and 1 preceding), 0) as middle
  from blocks join epochs using (key)),
taken as (
  select key, block, epoch,
         row_number() over (order by floor(1e9 * middle / greatest(budget, 1)), key, epoch, block) - 1 as position
  from placed where middle <= budget + 0.5)
select doc_id, source, n_tokens, epoch, t.block, position
from d join budget b using (key) join taken t on t.key = d.key and t.block = d.hash % b.n_blocks
"""
