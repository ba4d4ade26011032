"""BPE encoding and decoding with content-defined chunk reuse.

Texts are cut where a rolling hash of the last bytes has a given pattern, so equal passages
give equal chunks wherever they stand. A chunk is encoded once and its ids are reused for every
text of the task that shares it. A cut falls inside a word as a rule: a chunk keeps the
fragments at its two ends apart from its body of whole words, and at each join the two
fragments are put together and encoded anew. A join new to the task is checked against the
tokenizer's own encoding of it between its neighbours; if ids differ, the stretch is widened
by a word on both sides until they agree.

The tokenizer is called on the distinct words of chunks not met before; the ids of a batch's
chunks are gathered from the word memory at once, and texts are decoded from their ids. Both
memories are bounded and dropped when full, which costs time and never changes a result. Their scope is the
task: dealing chunks out to be encoded once for the whole table would move every text and all
its ids (see the README).

Defined results: a null or empty text has no ids and decodes to the empty string; repeated rows
get a row each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from periodstats.llm.hashing import mix


@dataclass(frozen=True)
class Settings:
    mask_bits: int = 9               # one cut in 2 ^ mask_bits bytes on average
    window: int = 16                 # bytes the rolling hash sees; a power of two
    chunk_bytes: int = 48_000_000    # bound of the chunk memory
    words: int = 800_000             # bound of the word memory, and of its ids at 16 a word
    word_bytes: int = 256            # longer words are not kept


_MARK = b"\x01"
_GEAR = mix(np.arange(7000, 7256, dtype=np.uint64)).astype(np.uint32)


def cuts(data: np.ndarray, settings: Settings) -> np.ndarray:
    """Ends of chunks inside ``data``: places where the rolling hash ends in zeros."""
    if len(data) <= settings.window:
        return np.empty(0, dtype=np.int64)
    h, width = _GEAR[data], 1
    while width < settings.window:  # gear hash of 2, 4, 8, ... bytes by doubling
        wider = h.copy()
        wider[width:] += h[:-width] << np.uint32(width)
        h, width = wider, 2 * width
    top = np.uint32(32 - settings.mask_bits)
    found = np.flatnonzero((h[settings.window - 1:] >> top) == 0) + settings.window
    return found[found < len(data)]


class Encoder:
    """Word and chunk memory around a tokenizer; made anew in each task."""

    def __init__(self, definition: str, settings: Settings) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.settings = settings
        self.numbers: dict[bytes, int] = {}   # word -> place in ``start``
        self.start = np.zeros(1, dtype=np.int64)
        self.flat = np.empty(0, dtype=np.uint32)  # ids of all words, end to end
        self.long: list[bytes] = []           # words to forget after the batch
        self.chunks: dict[bytes, list] = {}   # chunk -> fragment before, ids, fragment after
        self.held = 0
        self.reused = 0
        if self.tokenizer.decoder is not None:
            raise ValueError("only tokenizers that decode by joining tokens with spaces")
        self.mark = self.encode([_MARK])[0]
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.token = pa.array([self.tokenizer.id_to_token(i) or "" for i in range(size)],
                              pa.large_string())

    def encode(self, some: list[bytes]) -> list[np.ndarray]:
        """The tokenizer's own ids of each text."""
        made = self.tokenizer.encode_batch_fast([x.decode() for x in some], add_special_tokens=False)
        return [np.array(e.ids, dtype=np.uint32) for e in made]

    def decode(self, ids: list[bytes]) -> pa.Array:
        """The text of each, as ``decode`` gives it without a decoder: tokens joined by a space."""
        ends = np.cumsum([0, *[len(x) // 4 for x in ids]])
        tokens = self.token.take(pa.array(np.frombuffer(b"".join(ids), dtype="<u4")))
        lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), tokens)
        return pc.binary_join(lists, pa.scalar(" ", pa.large_string()))

    def make_room(self) -> None:
        if len(self.numbers) > self.settings.words or len(self.flat) > 16 * self.settings.words:
            self.numbers.clear()
            self.start = np.zeros(1, dtype=np.int64)
            self.flat = np.empty(0, dtype=np.uint32)
        for w in self.long:
            self.numbers.pop(w, None)
        self.long = []

    def learn(self, some: list[bytes]) -> None:
        """Encode words not met before, many in one string with a mark of its own between.

        The mark is one character that makes one id by itself; runs with a word that holds it,
        and runs whose marks do not come back one for one, are encoded word by word.
        """
        unknown = [w for w in dict.fromkeys(some) if w not in self.numbers]
        runs = [unknown[i:i + 256] for i in range(0, len(unknown), 256)]
        found, sizes = [self.flat], []
        joined = [b" \x01 ".join(run) for run in runs]
        for run, text, ids in zip(runs, joined, self.encode(joined), strict=True):
            ends = np.flatnonzero(ids == self.mark[0]) if len(self.mark) == 1 else ()
            if len(ends) == text.count(_MARK) == len(run) - 1:
                found.append(np.delete(ids, ends))
                sizes.append(np.diff(ends, prepend=-1, append=len(ids)) - 1)
            else:
                each = self.encode(run)
                found += each
                sizes.append(np.array([len(x) for x in each], dtype=np.int64))
        self.numbers.update(zip(unknown, range(len(self.start) - 1, len(self.start) - 1 + len(unknown))))
        self.long += [w for w in unknown if len(w) > self.settings.word_bytes]
        if unknown:
            self.flat = np.concatenate(found)
            self.start = np.concatenate((self.start, self.start[-1] + np.cumsum(np.concatenate(sizes))))

    def ids(self, word: bytes) -> bytes:
        n = self.numbers[word]
        return self.flat[self.start[n]:self.start[n + 1]].astype("<u4", copy=False).tobytes()

    def words(self, bodies: list[bytes]) -> list[bytes]:
        """Ids of the words in each body, in order."""
        if not bodies:
            return []
        parts = pc.ascii_split_whitespace(pa.array(bodies, pa.large_binary()).view(pa.large_string()))
        every = parts.flatten()
        some = pc.binary_length(every).to_numpy() > 0  # white space at a border gives empty strings
        coded = every.filter(pa.array(some)).view(pa.large_binary()).dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.learn(distinct)
        places = np.fromiter(map(self.numbers.__getitem__, distinct), np.int64, len(distinct))
        places = places[coded.indices.to_numpy()]
        first, size = self.start[places], self.start[places + 1] - self.start[places]
        ends = np.concatenate(([0], np.cumsum(size)))
        ids = self.flat[np.arange(ends[-1]) + np.repeat(first - ends[:-1], size)]
        ids = ids.astype("<u4", copy=False).tobytes()
        before = np.concatenate(([0], np.cumsum(some)))[parts.offsets.to_numpy()]
        cut = (4 * ends[before]).tolist()
        return [ids[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]

    def agree(self, runs: list[list[bytes]]) -> list[bool]:
        """Whether the tokenizer gives each run of words the ids of its words."""
        joined = [b" ".join(run) for run in runs]
        return [ids.astype("<u4", copy=False).tobytes() == own
                for ids, own in zip(self.encode(joined), self.words(joined), strict=True)]

    @staticmethod
    def parts(chunk: bytes) -> list[bytes] | None:
        """Fragment before, whole words, fragment after; None if there is no white space."""
        head = b"" if chunk[:1].isspace() else chunk.split(None, 1)[0] if chunk else chunk
        if len(head) == len(chunk):
            return None
        tail = b"" if chunk[-1:].isspace() else chunk.rsplit(None, 1)[-1]
        return [head, chunk[len(head):len(chunk) - len(tail)], tail]


def _split(text: bytes, settings: Settings) -> list[bytes]:
    ends = cuts(np.frombuffer(text, dtype=np.uint8), settings).tolist()
    return [text[a:b] for a, b in zip([0, *ends], [*ends, len(text)], strict=True)]


def encode_texts(texts: list[bytes], enc: Encoder) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit integers."""
    settings = enc.settings
    enc.make_room()
    fresh: dict[bytes, list | None] = {}
    new_joins: dict[bytes, tuple[int, int]] = {}  # a join not met before -> (text, place)
    plans = []  # per text its joins (bytes) and chunks (lists), in order
    for i, text in enumerate(texts):
        plan, carry, end = [], b"", 0

        def join(word: bytes, i: int = i) -> None:
            if word not in enc.numbers:
                new_joins.setdefault(word, (i, end))
            plan.append(word)

        for chunk in _split(text, settings):
            known = enc.chunks.get(chunk)
            if known is not None:
                enc.reused += 1
            elif chunk in fresh:
                known = fresh[chunk]
            else:
                known = fresh[chunk] = enc.parts(chunk)
            if known is None:
                carry += chunk
            else:
                if carry or known[0]:
                    join(carry + known[0])
                plan.append(known)
                carry = known[2]
            end += len(chunk)
        if carry:
            join(carry)
        plans.append(plan)
    made = [(chunk, parts) for chunk, parts in fresh.items() if parts is not None]
    for (_, parts), ids in zip(made, enc.words([parts[1] for _, parts in made]), strict=True):
        parts[1] = ids
    enc.learn(list(new_joins))
    wrong = _disagreeing(texts, new_joins, enc)
    out = []
    for i, plan in enumerate(plans):
        if i in wrong:  # words of this text depend on more than their neighbours
            out.append(enc.encode([texts[i]])[0].astype("<u4", copy=False).tobytes())
        else:
            out.append(b"".join([enc.ids(x) if type(x) is bytes else x[1] for x in plan]))
    for chunk, parts in made:
        if enc.held < settings.chunk_bytes:
            enc.chunks[chunk] = parts
            enc.held += 2 * len(chunk) + len(parts[1]) + 200
    if enc.held >= settings.chunk_bytes:
        enc.chunks.clear()
        enc.held = 0
    return out


def _disagreeing(texts: list[bytes], joins: dict[bytes, tuple[int, int]], enc: Encoder) -> set[int]:
    """Texts with a join that, encoded with ever more words around it, never agrees."""
    wrong: set[int] = set()
    left = [(i, max(0, end - len(word)), end + len(word), 24 + 2 * len(word))
            for word, (i, end) in joins.items()]
    while left:
        runs, whole = [], []
        for i, start, end, reach in left:
            lo, hi = max(0, start - reach), min(len(texts[i]), end + reach)
            run = texts[i][lo:hi].split()
            runs.append(run[lo > 0:len(run) - (hi < len(texts[i]))])
            whole.append(lo == 0 and hi == len(texts[i]))
        good = enc.agree(runs)
        wrong |= {x[0] for x, g, all_ in zip(left, good, whole, strict=True) if not g and all_}
        left = [(i, start, end, reach * 8) for (i, start, end, reach), g, all_
                in zip(left, good, whole, strict=True) if not g and not all_]
    return wrong


def _encode(definition, settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is all it has
        enc = Encoder(definition.value, settings)
        for batch in batches:
            column = batch.column("text").cast(pa.large_binary()).fill_null(b"")
            sizes = column.cast(pa.large_binary())
            lo, held, cut = 0, 0, []
            for i, n in enumerate(pc.binary_length(sizes).to_pylist()):
                held += n
                if held > 2_000_000:
                    cut.append((lo, i + 1))
                    lo, held = i + 1, 0
            cut.append((lo, len(column)))
            for a, b in cut:
                if a < b:
                    made = encode_texts(column.slice(a, b - a).to_pylist(), enc)
                    decoded = enc.decode(made)
                    yield pa.RecordBatch.from_arrays([
                        batch.column("doc_id").slice(a, b - a),
                        pa.array([len(x) // 4 for x in made], pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in made]),
                        pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in decoded]),
                        pa.array(made, pa.binary()),
                        decoded.cast(pa.string())],
                        names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"])
    return run


def encode(docs: DataFrame, tokenizer_file: str, settings: Settings | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids (little-endian uint32), decoded."""
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInArrow(
        _encode(definition, settings or Settings()),
        "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, "
        "ids binary, decoded string")


def digests(docs: DataFrame, tokenizer_file: str, settings: Settings | None = None) -> DataFrame:
    """``encode`` without the ids and texts, which then do not leave the worker."""
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    whole = _encode(definition, settings or Settings())
    kept = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole(batches):
            yield batch.select(kept)

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
