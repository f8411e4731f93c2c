"""CRC-32 in DuckDB SQL, for the oracles."""

_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END"


def _table() -> str:
    rows = "(SELECT i, i AS c FROM range(256) t(i))"
    for _ in range(8):
        rows = f"(SELECT i, {_STEP} AS c FROM {rows})"
    return f"crc AS (SELECT list(c ORDER BY i) AS crc_of_byte FROM {rows})"


#: A common table expression of one row, to be joined where ``crc_sql`` is used.
CRC_TABLE = _table()


def crc_sql(ascii_text: str) -> str:
    """Unsigned CRC-32 of an expression whose value has only ASCII characters."""
    codes = f"[ord(x)::BIGINT FOR x IN string_split({ascii_text}, '')]"
    folded = f"list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, x: xor(a >> 8, crc_of_byte[(xor(a, x) & 255) + 1]))"
    return f"xor({folded}, 4294967295::BIGINT)"
