"""Byte-pair encoding and decoding as streaming transducers with constant memory.

Encoder. A text arrives in pieces. It is cut into words as the vocabulary asks; a finished word
is encoded and its ids leave at once. A word that does not end (a long run without a break) is
not kept whole: how far the letters still to come can change what was read is bounded by the
merge list, and ids farther from the end than that bound are emitted.

The bound ("sufficient lookahead"): merges apply in order of rank, and all places of one rank
from left to right. So news from the right end travels leftwards only from a merge (a, b) to a
later merge (c, d) whose right part d is a (it may be taken away) or ab (it may appear), each
time by the bytes of c. The heaviest chain of that kind, computed once per merge list in order
of rank, bounds the bytes. What stands left and right of a boundary that no merge crosses was
merged independently, so encoding goes on from such a boundary without what lies before it.

Decoder. Ids give bytes; a UTF-8 state machine gives the characters that are complete and keeps
up to three bytes of one that is not. Invalid bytes become U+FFFD.

`encode_documents` returns a row per input row. A null text counts as empty (0 ids, the digests
of nothing); equal rows give equal rows; other columns are ignored, and a null doc_id stays null.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: White space as the vocabulary's own cutting pattern means it (fixed values).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The cutting pattern of the byte-level vocabulary (fixed value).
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
#: Characters read at a time, ids decoded at a time, and the end of what was read in which a
#: word may still change its form ('l before another l, the last space before a word).
PIECE, IDS, OPEN_END = 1 << 16, 1 << 12, 4
#: A longer unfinished word is emitted as far as it is stable.
LONG_WORD = 4096
LONGEST_REMEMBERED, MOST_REMEMBERED = 48, 500_000
#: Stands for a pair that does not merge: above every rank.
NO_MERGE = (1 << 60, -1)
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class MergeList:
    """Ids, ranks and the sufficient lookahead of a byte-level merge list."""

    def __init__(self, path: str):
        data = json.load(open(path, encoding="utf-8"))
        vocab = data["model"]["vocab"]
        letters = byte_names()
        self.bytes_of: dict[int, bytes] = {}
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(letters[c] for c in token)
        self.id_of_byte = {b: vocab[c] for c, b in letters.items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        for text, i in self.special.items():
            self.bytes_of[i] = text.encode()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        self.merges = {
            (vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)
        }
        self.lookahead = sufficient_lookahead(
            [(a, b, made, len(self.bytes_of[a]), len(self.bytes_of[b]))
             for (a, b), (_, made) in self.merges.items()]
        )

    def encode_word(self, word: bytes) -> list[int]:
        ids = [self.id_of_byte[b] for b in word]
        return self._short(ids) if len(ids) <= 64 else self._long(ids)

    def _short(self, ids: list[int]) -> list[int]:
        merges = self.merges.get
        pairs = [merges(p, NO_MERGE) for p in zip(ids, ids[1:])]
        while pairs and (best := min(pairs)) is not NO_MERGE:
            i = pairs.index(best)
            ids[i: i + 2] = (best[1],)
            del pairs[i]
            if i:
                pairs[i - 1] = merges((ids[i - 1], ids[i]), NO_MERGE)
            if i < len(pairs):
                pairs[i] = merges((ids[i], ids[i + 1]), NO_MERGE)
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        """The same with a queue of pairs, for words of many bytes."""
        n, merges = len(ids), self.merges
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        queue = [
            (m[0], i, ids[i], ids[i + 1], m[1])
            for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))
        ]
        heapq.heapify(queue)
        alive = [True] * n
        while queue:
            _, i, a, b, made = heapq.heappop(queue)
            j = after[i]
            if not alive[i] or ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], alive[j] = made, False
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (m := merges.get((ids[left], ids[right]))):
                    heapq.heappush(queue, (m[0], left, ids[left], ids[right], m[1]))
        return [x for x, keep in zip(ids, alive) if keep]


@lru_cache(maxsize=1)
def byte_names() -> dict[str, int]:
    """Printable character -> byte: bytes that print stand for themselves, the others follow
    from code point 256 on, in order."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printing)]
    return {chr(b): b for b in printing} | {chr(256 + i): b for i, b in enumerate(rest)}


def sufficient_lookahead(merges: Iterable[tuple[int, int, int, int, int]]) -> int:
    """Bytes after which what was read no longer changes. `merges`: (left id, right id, made id,
    bytes of left, bytes of right) in order of rank."""
    reach: dict[int, int] = {}
    most = 0
    for left, right, made, n_left, n_right in merges:
        far = n_left + max(reach.get(right, 0), n_right)
        most = max(most, far)
        for token in (left, made):
            reach[token] = max(reach.get(token, 0), far)
    return most


class Encoder:
    """feed() takes text, finish() ends it; both return the ids that have become certain."""

    def __init__(self, merges: MergeList):
        self.merges = merges
        self.words = regex.compile(WORDS)
        self.pending = ""
        self.memory: dict[str, list[int]] = {}
        special = sorted(merges.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.longest_special = max(map(len, special), default=1)

    def feed(self, text: str) -> list[int]:
        self.pending += text
        out: list[int] = []
        while self.special and (m := self.special.search(self.pending)):
            tail = self.pending[m.end():]
            self.pending = self.pending[: m.start()]
            out += self._segment(True)
            out.append(self.merges.special[m[0]])
            self.pending = tail
        return out + self._segment(False)

    def finish(self) -> list[int]:
        return self._segment(True)

    def _segment(self, ended: bool) -> list[int]:
        text, self.pending = self.pending, ""
        if not text:
            return []
        if ended:
            return self._ids(self.words.findall(text))
        safe = len(text) - max(OPEN_END, self.longest_special - 1)
        found = [(m.start(), m.end()) for m in self.words.finditer(text)]
        done = 0
        while done < len(found) and found[done][1] <= safe:
            done += 1
        out = self._ids([text[a:b] for a, b in found[:done]])
        rest = text[found[done][0]:] if done < len(found) else ""
        if done < len(found) and min(found[done][1], safe) - found[done][0] > LONG_WORD:
            stable, used = self._stable(text[found[done][0]: min(found[done][1], safe)])
            out += stable
            rest = rest[used:]
        self.pending = rest
        return out

    def _stable(self, start: str) -> tuple[list[int], int]:
        """Ids of a word's start that no continuation changes, and the characters they take.
        Only boundaries between characters count, so that the rest is text again."""
        data = start.encode()
        limit = len(data) - self.merges.lookahead
        ids, at, cut, keep = self.merges.encode_word(data), 0, 0, 0
        for n, i in enumerate(ids, 1):
            at += len(self.merges.bytes_of[i])
            if at > limit:
                break
            if at == len(data) or data[at] & 0xC0 != 0x80:
                cut, keep = at, n
        return ids[:keep], len(data[:cut].decode())

    def _ids(self, words: list[str]) -> list[int]:
        out: list[int] = []
        for word in words:
            ids = self.memory.get(word)
            if ids is None:
                ids = self.merges.encode_word(word.encode())
                if len(word) <= LONGEST_REMEMBERED:
                    if len(self.memory) >= MOST_REMEMBERED:
                        self.memory.clear()
                    self.memory[word] = ids
            out += ids
        return out

    def stream(self, text: str) -> Iterator[list[int]]:
        """Ids of one whole text, piece by piece."""
        if len(text) <= PIECE and not (self.special and self.special.search(text)):
            yield self._ids(self.words.findall(text))
            return
        for at in range(0, len(text), PIECE):
            yield self.feed(text[at: at + PIECE])
        yield self.finish()


class Decoder:
    """push() takes ids, close() ends them; both return the text that is complete."""

    def __init__(self, merges: MergeList):
        self.bytes_of = merges.bytes_of
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, ids: list[int]) -> str:
        return self.state.decode(b"".join(map(self.bytes_of.__getitem__, ids)))

    def close(self) -> str:
        text = self.state.decode(b"", True)
        self.state.reset()
        return text


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    """One encoder, with the words it remembers, for each Python worker."""
    return Encoder(MergeList(path))


def digests(encoder: Encoder, text: str | None) -> tuple[int, str, str]:
    """Number of ids, digest of their decimal forms, digest of the text decoded from them."""
    decoder = Decoder(encoder.merges)
    ids_sha, text_sha, n = hashlib.sha256(), hashlib.sha256(), 0
    for ids in encoder.stream(text or ""):
        for at in range(0, len(ids), IDS):
            part = ids[at: at + IDS]
            ids_sha.update(("," if n else "").encode() + ",".join(map(str, part)).encode())
            text_sha.update(decoder.push(part).encode())
            n += len(part)
    text_sha.update(decoder.close().encode())
    return n, ids_sha.hexdigest(), text_sha.hexdigest()


def encode_documents(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; see the module's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            found = [digests(encoder, t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([x[0] for x in found], pa.int64()),
                    pa.array([x[1] for x in found], pa.string()),
                    pa.array([x[2] for x in found], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return documents.select("doc_id", "text").mapInArrow(run, SCHEMA)
