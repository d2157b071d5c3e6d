"""Encoding texts by a byte-level BPE vocabulary with a lazily determinised finite-state transducer.

Each prefix of a pre-token has one last token, and a token may follow another only if the two, encoded together, stay
the two. A state holds, for every place from which a vocabulary entry may still be under way, that entry's node in the
vocabulary tree and the last token before it. States and transitions are made when first met and kept. Reading a byte
fixes the last token of the prefix read so far. Whatever comes next, the tokens go on from one of the places that the
state holds; the tokens before the last boundary that all of these share are certain. They are emitted, and what led to
them is forgotten, after every ``AHEAD`` bytes and at the end of a pre-token; only what lies between is kept.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from quirelake.tables import latest_rows, spread, table

#: Folder of the public tokenizers' files; pass another where they lie elsewhere.
TOKENIZERS = "/opt/tokenizers"
# Fixed value: the pre-token pattern that belongs to the vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Kept states and pre-tokens; beyond these a cache is emptied and filled anew, with the same results.
MAX_STATES, MAX_WORDS = 400_000, 400_000
START = -1
#: Bytes read before the tokens that have become certain are emitted.
AHEAD = 512


class Transducer:
    """Ids of byte strings under a vocabulary of ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.texts = ranks, {i: t for t, i in ranks.items()}
        self.size = {i: len(t) for t, i in ranks.items()}
        # Vocabulary tree: node -> {byte: node}, and the token that ends there.
        self.child: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        self.depth: list[int] = [0]
        for t, i in ranks.items():
            if len(t) > 1 and self.merged(t) != [i]:
                continue  # no sequence of merges makes it
            node = 0
            for b in t:
                nxt = self.child[node].get(b)
                if nxt is None:
                    nxt = self.child[node][b] = len(self.child)
                    self.child.append({})
                    self.ends.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = nxt
            self.ends[node] = i
        self.follows: dict[tuple[int, int], bool] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        self.reset()

    def reset(self) -> None:
        first = ((0, START),)
        self.number, self.states, self.step = {first: 0}, [first], {}

    def merged(self, text: bytes) -> list[int]:
        """Plain merging by rank; used to compile the vocabulary and its pairs, not to encode texts."""
        parts = [text[i : i + 1] for i in range(len(text))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def may_follow(self, a: int, b: int) -> bool:
        key = (a, b)
        known = self.follows.get(key)
        if known is None:
            known = self.follows[key] = self.merged(self.texts[a] + self.texts[b]) == [a, b]
        return known

    def grow(self, state: int, byte: int) -> tuple[int, int]:
        """The transition from ``state`` on ``byte``: the next state and the last token then."""
        live, last = [], None
        for node, before in self.states[state]:
            nxt = self.child[node].get(byte)
            if nxt is None:
                continue
            live.append((nxt, before))
            token = self.ends[nxt]
            if token >= 0 and last is None and (before == START or self.may_follow(before, token)):
                last = token
        key = (*live, (0, last))
        if (number := self.number.get(key)) is None:
            number = self.number[key] = len(self.states)
            self.states.append(key)
        self.step[state << 8 | byte] = made = (number, last)
        return made

    def encode(self, text: bytes) -> list[int]:
        stream = Stream(self)
        if len(text) <= AHEAD:
            stream.read(text)
            return stream.end()
        out: list[int] = []
        for at in range(0, len(text), AHEAD):
            out += stream.feed(text[at : at + AHEAD])
        return out + stream.end()

    def word(self, word: str) -> tuple[int, ...]:
        if len(self.words) > MAX_WORDS:
            self.words.clear()
        ids = tuple(self.encode(word.encode("utf-8", "replace")))
        if len(word) < 64:
            self.words[word] = ids
        return ids

    def ids(self, text: str) -> list[int]:
        """Ids of a text, without special tokens; their strings are ordinary text."""
        out: list[int] = []
        known, more = self.words.get, out.extend
        for word in _SPLIT(text):
            more(known(word) or self.word(word))
        return out


class Stream:
    """One pre-token's bytes in, tokens out as they become certain."""

    def __init__(self, machine: Transducer):
        if len(machine.states) > MAX_STATES:
            machine.reset()
        self.machine, self.state = machine, 0
        #: The last token of each prefix that ends after the last boundary emitted.
        self.lasts: list[int] = []

    def read(self, data: bytes) -> None:
        state, machine, keep = self.state, self.machine, self.lasts.append
        step = machine.step
        for byte in data:
            made = step.get(state << 8 | byte)
            state, last = made if made is not None else machine.grow(state, byte)
            keep(last)
        self.state = state

    def emit(self, end: int) -> list[int]:
        """The tokens up to a boundary, by following the last tokens back from it."""
        out, size, lasts, at = [], self.machine.size, self.lasts, end
        while at > 0:
            out.append(lasts[at - 1])
            at -= size[lasts[at - 1]]
        out.reverse()
        del lasts[:end]
        return out

    def feed(self, data: bytes) -> list[int]:
        self.read(data)
        machine, size, lasts = self.machine, self.machine.size, self.lasts
        live, n = machine.states[self.state], len(self.lasts)
        # The places that the tokens may go on from, each led back until all meet at one boundary.
        places = {n - machine.depth[node] for node, _ in live}
        while len(places) > 1:
            far = max(places)
            places.remove(far)
            places.add(far - size[lasts[far - 1]])
        out = self.emit(places.pop())
        if len(machine.states) > MAX_STATES:
            machine.reset()
            self.state = machine.number.setdefault(live, len(machine.states))
            if self.state == len(machine.states):
                machine.states.append(live)
        return out

    def end(self) -> list[int]:
        return self.emit(len(self.lasts))


_SPLIT = regex.compile(PATTERN).findall


@lru_cache(maxsize=4)
def transducer(path: str) -> Transducer:
    """The transducer of a vocabulary file with lines of base64 text and rank; one for each Python process."""
    ranks = {base64.b64decode(text): int(rank) for text, rank in map(bytes.split, Path(path).read_bytes().splitlines())}
    return Transducer(ranks)


class Decoder:
    """Ids to text piece by piece: bytes of a character that isn't complete yet wait for the next call."""

    # Fixed values of UTF-8: first byte below this bound -> length of the character.
    _LENGTHS = ((0x80, 1), (0xC2, 0), (0xE0, 2), (0xF0, 3), (0xF5, 4), (0x100, 0))

    def __init__(self, machine: Transducer):
        self.texts, self.waiting = machine.texts, b""

    def feed(self, ids: list[int]) -> str:
        data = self.waiting + b"".join(self.texts[i] for i in ids)
        cut = len(data)
        for back in range(1, min(4, cut) + 1):
            byte = data[cut - back]
            if byte & 0xC0 != 0x80:
                length = next(n for bound, n in self._LENGTHS if byte < bound)
                if length > back:
                    cut -= back
                break
        self.waiting = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        rest, self.waiting = self.waiting.decode("utf-8", "replace"), b""
        return rest


def encode(df: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """(key, ids): the token ids of each row's text; null and empty texts have an empty list.

    Runs on Arrow batches: one flat array of ids and its offsets go back to Spark, no Python object for each row.
    """
    path = path or f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
    narrow = df.select(key, text)

    def batches(parts):
        machine = transducer(path)
        for part in parts:
            flat, offsets = [], [0]
            for t in part.column(1).to_pylist():
                if t:
                    flat += machine.ids(t)
                offsets.append(len(flat))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], names=[key, "ids"])

    schema = StructType([narrow.schema[key], StructField("ids", ArrayType(IntegerType(), False), False)])
    return spread(narrow).mapInArrow(batches, schema)


def decode(df: DataFrame, key: str, ids: str, path: str | None = None) -> DataFrame:
    """(key, text): the text of each row's token ids, decoded as they come; null ids give null, an empty list the empty text."""
    path = path or f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
    narrow = df.select(key, ids)

    def batches(parts):
        machine = transducer(path)
        for part in parts:
            texts = []
            for row in part.column(1).to_pylist():
                reader = Decoder(machine)
                texts.append(None if row is None else "".join([*(reader.feed(row[at : at + AHEAD]) for at in range(0, len(row), AHEAD)), reader.end()]))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return spread(narrow).mapInArrow(batches, StructType([narrow.schema[key], StructField("text", StringType())]))


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return latest_rows(table(spark, folder, "documents").select("doc_id", "text", "ingested_at"), "doc_id", "ingested_at")


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, ids) of each document by byte_bpe_50k."""
    return encode(_documents(spark, folder), "doc_id", "text")


def p8_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, text): each document's text after encoding and decoding, the empty text for null."""
    return decode(p8_ids(spark, folder), "doc_id", "ids")
