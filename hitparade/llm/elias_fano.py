"""Elias-Fano code of a rising sequence: low bits as they are, high bits in unary, with select samples."""

import struct

import numpy as np

HEAD = struct.Struct("<QQBI")
#: The place of every SAMPLEth set bit is stored, so that a select reads a bounded stretch.
SAMPLE = 256


class EliasFano:
    """values[i] for 0 <= i < n, in about 2 + log2(largest / n) bits each."""

    def __init__(self, n: int, largest: int, width: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.largest, self.width, self.low, self.high, self.samples = n, largest, width, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, np.uint64)
        n = len(values)
        if n and np.any(values[1:] < values[:-1]):
            raise ValueError("the sequence falls")
        largest = int(values[-1]) if n else 0
        width = max(0, (largest // n).bit_length() - 1) if n else 0
        bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
        ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        pack = lambda x: np.packbits(x.astype(np.uint8).ravel(), bitorder="little")
        return cls(n, largest, width, pack(bits), pack(high), ones[::SAMPLE].astype("<u4"))

    def _low(self, start: int, end: int) -> np.ndarray:
        first, last = start * self.width, end * self.width
        bits = np.unpackbits(self.low[first // 8 : (last + 7) // 8], bitorder="little")[first % 8 :][: last - first]
        weights = np.uint64(1) << np.arange(self.width, dtype=np.uint64)
        return (bits.reshape(end - start, self.width).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)

    def run(self, start: int, end: int) -> np.ndarray:
        """values[start:end], from the sample at or before start to the one after end: a stretch as long as the run."""
        if not 0 <= start <= end <= self.n:
            raise IndexError((start, end))
        if start == end:
            return np.empty(0, np.int64)
        first, last = start // SAMPLE, -(-end // SAMPLE)
        begin = int(self.samples[first]) // 8
        stop = int(self.samples[last]) // 8 + 1 if last < len(self.samples) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[begin:stop], bitorder="little")) + 8 * begin
        ones = ones[ones >= int(self.samples[first])][start % SAMPLE :][: end - start]
        high = (ones - np.arange(start, end)).astype(np.uint64) << np.uint64(self.width)
        return (high | self._low(start, end) if self.width else high).astype(np.int64)

    def select(self, i: int) -> int:
        """values[i], from one sample on."""
        return int(self.run(i, i + 1)[0])

    def all(self) -> np.ndarray:
        return self.run(0, self.n)

    def to_bytes(self) -> bytes:
        parts = self.low.tobytes(), self.high.tobytes(), self.samples.astype("<u4").tobytes()
        head = HEAD.pack(self.n, self.largest, self.width, SAMPLE) + struct.pack("<3Q", *map(len, parts))
        return head + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> "EliasFano":
        n, largest, width, sample = HEAD.unpack_from(data)
        if sample != SAMPLE:
            raise ValueError("another sample rate")
        sizes = struct.unpack_from("<3Q", data, HEAD.size)
        ends = np.cumsum((HEAD.size + 24, *sizes))
        low, high, samples = (np.frombuffer(data, np.uint8, e - s, s) for s, e in zip(ends, ends[1:]))
        return cls(n, largest, width, low, high, samples.view("<u4"))
