"""CRC-32 over whole columns: checksums of many substrings at once, and of strings put together."""

import numpy as np

#: Fixed value: the reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
_FULL = np.uint32(0xFFFFFFFF)


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    return table.astype(np.uint32)


_TABLE = _byte_table()
#: Up to this many bytes a checksum is moved in one step.
_STEP = 256


def _shift_tables() -> np.ndarray:
    """For n = 0.._STEP and each of the four bytes of a checksum: what n zero bytes make of it."""
    low = np.arange(256, dtype=np.uint32)
    tables = np.empty((_STEP + 1, 4, 256), dtype=np.uint32)
    tables[0] = np.stack([low << np.uint32(8 * k) for k in range(4)])
    for n in range(_STEP):
        tables[n + 1] = _TABLE[tables[n] & 255] ^ (tables[n] >> 8)
    return tables.reshape(-1)


_SHIFT = _shift_tables()


def shift(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Checksums after ``n`` zero bytes: ``crc(a + b) == shift(crc(a), len(b)) ^ crc(b)``."""
    crc, n = crc.astype(np.uint32), n.astype(np.int64)
    far = np.flatnonzero(n > _STEP)
    if len(far):
        crc, n = crc.copy(), n.copy()
        while len(far):
            crc[far] = shift(crc[far], np.full(len(far), _STEP))
            n[far] -= _STEP
            far = far[n[far] > _STEP]
    at = n * 1024
    out = _SHIFT[at + (crc & 255)]
    for k in (1, 2, 3):
        out = out ^ _SHIFT[at + 256 * k + ((crc >> np.uint32(8 * k)) & 255)]
    return out


def of_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """Checksums of data[start:end], each going on from the checksum ``before`` of what stands in front."""
    state = np.full(len(starts), _FULL) if before is None else before.astype(np.uint32) ^ _FULL
    order = np.argsort(ends - starts, kind="stable")[::-1]  # longest first: those still running are a prefix
    sizes, at, state = (ends - starts)[order], starts[order], state[order]
    for k in range(int(sizes[0]) if len(sizes) else 0):
        running = int(np.searchsorted(-sizes, -k, "left"))
        state[:running] = _TABLE[(state[:running] ^ data[at[:running] + k]) & 255] ^ (state[:running] >> 8)
    out = np.empty(len(starts), dtype=np.uint32)
    out[order] = state ^ _FULL
    return out
