"""Token ids of many texts by a tokenizer of the tokenizers library.

A text is encoded in the chunks between ASCII white space. That gives the ids of the whole text for tokenizers that drop
white space, whose normalizer maps white space to white space and whose pre-tokenizer never joins over it: no token, no
special string and no composed character reaches over such a place.
"""

from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from hitparade.llm import words

#: Pieces that a Python worker remembers before it starts afresh, some 40 MB; the ids do not depend on it.
REMEMBERED = 200_000

#: Texts that tell tokenizers of other kinds: white space, case, marks, digits, accents, special strings.
PROBES = (
    "Some plain words, then MARKS! And 12 digits.", " it's  I'LL\t\nstraße É é x", "a.b,c <|endoftext|> d-e (f) g; 3.14", "日本語 テキスト 😀 ok", "", " \n ",
)


class ChunkEncoder:
    """ids of texts; definition is the tokenizer's JSON.

    Chunks of plain letters and closing marks are two pre-tokens; their letters are looked up in lower case, so that the
    library's model sees each word once. Every other chunk goes through the whole tokenizer. A tokenizer that gives a probe
    other ids in chunks than as a whole is refused.
    """

    def __init__(self, definition: str):
        self.tokenizer = Tokenizer.from_str(definition)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids are held in 16 bits")
        self.model = self.tokenizer.model
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.as_bytes = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.letters: dict[str, bytes] = {}
        self.others: dict[str, bytes] = {}
        for text in PROBES:
            if self.encode(pa.array([text]))[0].tolist() != self.tokenizer.encode(text, add_special_tokens=False).ids:
                raise ValueError(f"a tokenizer of another kind: its ids of {text!r} are not those of its chunks")

    def _whole(self, chunks: list[str]) -> list[bytes]:
        return [array("H", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def _words(self, letters: list[str]) -> list[bytes]:
        shown = (x if x.isascii() else x.translate(self.as_bytes) for x in letters)
        return [array("H", [t.id for t in self.model.tokenize(x)]).tobytes() for x in shown]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the offsets of the texts; null texts have none."""
        if len(self.letters) + len(self.others) > REMEMBERED:
            self.letters.clear()
            self.others.clear()
        codes, offsets, chunks = words.split(texts)
        plain, letters, marks = words.plain_parts(chunks)
        parts = (
            words.looked_up(pc.utf8_lower(letters), self.letters, self._words),
            words.looked_up(marks, self.others, self._whole),
            words.looked_up(chunks.filter(pa.array(~plain)), self.others, self._whole),
        )
        # Each chunk is two pieces: letters and marks, or the whole and nothing.
        pieces = [b"", *(ids for values, _ in parts for ids in values)]
        base = np.cumsum([1, *(len(values) for values, _ in parts)])
        places = np.zeros((len(chunks), 2), np.int64)
        places[plain, 0], places[plain, 1] = parts[0][1] + base[0], parts[1][1] + base[1]
        places[~plain, 0] = parts[2][1] + base[2]
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 2
        flat = np.frombuffer(b"".join(pieces), np.uint16)
        ragged = places[codes].ravel()
        lengths = sizes[ragged]
        ids = flat[words.gathered((np.cumsum(sizes) - sizes)[ragged], lengths)]
        return ids, np.r_[0, np.cumsum(lengths)][2 * offsets]


@lru_cache(maxsize=2)
def encoder(definition: str) -> ChunkEncoder:
    """One for all tasks of a Python worker."""
    return ChunkEncoder(definition)


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with end_id after each text."""
    n = len(offsets) - 1
    out = np.full(len(ids) + n, end_id, ids.dtype)
    ends = offsets + np.arange(n + 1)
    keep = np.ones(len(out), bool)
    keep[ends[1:] - 1] = False
    out[keep] = ids
    return out, ends
