"""CRC-32 in SQL for engines that have no function for it."""

# SQL without crc32: the table of the polynomial's remainders, and one step a byte.
CRC_SQL = """
remainders AS (
    SELECT list_transform(range(256), lambda i: list_reduce(range(8),
        lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS r
), crcs AS (
    SELECT word, xor(4294967295, list_reduce(
               list_transform(range(octet_length(encode(word))),
                              lambda i: 16 * (instr('0123456789ABCDEF', hex(encode(word))[2 * i + 1]) - 1)
                                        + instr('0123456789ABCDEF', hex(encode(word))[2 * i + 2]) - 1),
               lambda c, b: xor(c >> 8, r[(xor(c, b) & 255) + 1]), 4294967295)) AS crc
    FROM (SELECT DISTINCT word FROM {words}) CROSS JOIN remainders
)"""
