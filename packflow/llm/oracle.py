"""Pieces of DuckDB SQL that several oracles share."""

from __future__ import annotations

#: CTEs that give ``crc_table`` one row with ``crcs``, the 256 entries of the table of crc32 (needs WITH RECURSIVE)
CRC_TABLE = """crc_steps(n, c, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL
  SELECT n, CASE WHEN (c & 1) = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM crc_steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY n) AS crcs FROM crc_steps WHERE k = 8)"""


def crc_sql(text: str) -> str:
    """crc32 of the UTF-8 bytes of a text expression, beside ``crc_table``."""
    start = "CAST(4294967295 AS BIGINT)"
    value = (f"list_transform(range(1, octet_length(encode({text})) + 1), "
             f"lambda i: CAST(('0x' || substr(hex(encode({text})), CAST(2 * i - 1 AS BIGINT), 2)) AS BIGINT))")
    return (f"xor(list_reduce(list_prepend({start}, {value}), "
            f"lambda crc, byte: xor(crc >> 8, crcs[(xor(crc, byte) & 255) + 1])), {start})")
