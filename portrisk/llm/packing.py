"""Vector bin packing of tokenized texts into sequences, by the dot-product heuristic.

A piece has a vector of demands (tokens, segments, loss-bearing tokens) and a sequence has a
capacity in each. An open sequence takes, among the pieces that fit, the one whose demand has
the largest dot product with what is left of the capacity; what then stays free is filled by
cutting a piece. Work is done partition by partition without a shuffle.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from portrisk.llm import textkit

TOKENS, END_ID = 2048, 1
POOL = 512
CACHE_WORDS = 1_000_000
SLICE = 1 << 20
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long, sequence_id long, offset long"
_state: dict = {}

# fixed values: letters and digits among ASCII and the Latin letters from U+00C0 to U+00FF, none of which composes with another
PLAIN_CLASSES = {r"\p{L}": r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff", r"\p{N}": "0-9"}
PLAIN = r"\x21-\x7e\xc0-\xff"


def _rules(path: str) -> tuple[re.Pattern, re.Pattern, str] | None:
    """How the file cuts plain words that stand in lines, what makes a word other than plain, and the mark of a piece's last id.

    None if the file does not say that case and white space are dropped and that text is cut
    at matches of one pattern without looking around; its texts are then encoded whole.
    """
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    steps = {x["type"]: x for x in (told["normalizer"] or {}).get("normalizers", [])}
    cuts = (told["pre_tokenizer"] or {}).get("pretokenizers", [])
    split = cuts[0] if [x["type"] for x in cuts] == ["Split", "ByteLevel"] else {}
    pattern = split.get("pattern", {}).get("Regex", "")
    for name, plain in PLAIN_CLASSES.items():
        pattern = pattern.replace(name, plain)
    special = told["added_tokens"]
    known = (
        set(steps) == {"NFC", "Replace", "Lowercase"} and steps["Replace"]["pattern"] == {"Regex": r"\s+"} and steps["Replace"]["content"] == " "
        and pattern and "\\p" not in pattern and "(?" not in pattern and split["invert"] and split["behavior"] == "Removed"
        and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"] and told["model"].get("end_of_word_suffix") and not told["post_processor"]
        and not any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] or x["content"].split() != [x["content"]] for x in special)
    )
    if not known:
        return None
    odd = "|".join([f"[^\\n{PLAIN}]", *(re.escape(x["content"]) for x in special)])
    return re.compile(f"{pattern}|\\n"), re.compile(odd), told["model"]["end_of_word_suffix"]


def _slices(text: bytes) -> Iterator[bytes]:
    """The text in slices of about SLICE bytes, cut at ASCII white space only."""
    start = 0
    while len(text) - start > SLICE:
        space = _SPACE.search(text, start + SLICE)
        if not space:
            break
        yield text[start : space.start()]
        start = space.start()
    yield text[start:] if start else text


_SPACE = re.compile(rb"[\x20\x09-\x0d]")
WIDE = 24
_FILL = np.array([(1 << 64) - (1 << 8 * n) for n in range(9)], np.uint64)  # the bytes after the first n of eight
_SPACES, _FACTOR = np.uint64(0x2020202020202020), np.uint64(0x9E3779B97F4A7C15)
_BREAK = b"\xff" * 4  # parts the ids of words; no id looks like it, as the last byte of each is zero


class Recent:
    """Values by key of what was asked for lately: half of `most` entries, and as many that were before them."""

    def __init__(self, most: int) -> None:
        self.most, self.now, self.old = most, {}, {}

    def missing(self, wanted: set) -> list:
        """What the caller must add to `now`, which then holds all that is wanted."""
        fresh = wanted.difference(self.now)
        if len(self.now) + len(fresh) > self.most // 2:
            self.old, self.now, fresh = self.now, {}, wanted
        old = self.old
        self.now.update([(x, old[x]) for x in fresh if x in old])
        return [x for x in fresh if x not in old]


class Known:
    """Ids of short words, found for many words at once: one place for each hash, taken by the latest word.

    A word of up to WIDE bytes is its own key, filled up with spaces, so nothing is found for another word.
    """

    def __init__(self, most: int) -> None:
        self.bits = max(1, most.bit_length() - 1)
        self.keys = [np.full(1 << self.bits, _SPACES) for _ in range(WIDE // 8)]
        self.at, self.size = (np.zeros(1 << self.bits, np.int64) for _ in range(2))
        self.ids, self.end = np.zeros(1 << self.bits, np.uint32), 0

    def keys_of(self, raw: bytes, starts: np.ndarray, sizes: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Keys and places of words in `raw`, which ends with WIDE bytes more."""
        eight = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
        keys, hashed = [], np.zeros(len(starts), np.uint64)
        for i in range(0, WIDE, 8):
            filled = _FILL[np.clip(sizes - i, 0, 8)]
            keys.append(eight[starts + i] & ~filled | filled & _SPACES)
            hashed = (hashed ^ keys[-1]) * _FACTOR
            hashed ^= hashed >> np.uint64(32)
        return keys, (hashed * _FACTOR >> np.uint64(64 - self.bits)).astype(np.int64)

    def hold(self, ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Where ids are put, and how many."""
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        at = self.end + np.cumsum(size) - size
        more = self.end + int(size.sum())
        if more > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.end], np.zeros(2 * more - self.end, np.uint32)])
        self.ids[self.end : more] = np.frombuffer(b"".join(ids), "<u4")
        self.end = more
        return at, size

    def note(self, keys: list[np.ndarray], place: np.ndarray, at: np.ndarray, size: np.ndarray) -> None:
        for held, new in zip([*self.keys, self.at, self.size], [*keys, at, size], strict=True):
            held[place] = new

    def forget(self) -> None:
        """Begin anew once many ids are held."""
        if self.end > 8 << self.bits:
            self.ids, self.end = np.zeros(1 << self.bits, np.uint32), 0
            for held in self.keys:
                held[:] = _SPACES


class WordTokenizer:
    """Ids by a tokenizer that drops white space and case, word by word.

    Such a tokenizer never joins what ASCII white space separates, nor two of its own pieces. So
    words are looked up, the pieces of new plain words are encoded once, many at a
    time, and other new words (other letters, control characters, special tokens) as a whole.
    A cache that is full forgets, which changes no result; words above WIDE bytes are never held.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a worker for each core
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.rules = _rules(path)
        self.words, self.pieces = Known(CACHE_WORDS), Recent(CACHE_WORDS)
        if self.rules:
            vocabulary = self.tokenizer.get_vocab()
            self.last = np.zeros(max(vocabulary.values()) + 1, bool)
            self.last[[i for x, i in vocabulary.items() if x.endswith(self.rules[2])]] = True
            self.merger = Tokenizer.from_file(path)  # for plain pieces, which are normal and cut already
            self.merger.normalizer = normalizers.Sequence([])
            bytes_only = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.merger.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), bytes_only])

    def _ids(self, texts: list[str], tokenizer=None) -> list[bytes]:
        found = (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _learn_pieces(self, fresh: list[str]) -> None:
        """Many pieces are encoded as one text; each ends with an id that bears the mark."""
        for at in range(0, len(fresh), 4096):
            part = fresh[at : at + 4096]
            raw = self._ids([" ".join(part)], self.merger)[0]
            ends = (4 * (np.flatnonzero(self.last[np.frombuffer(raw, "<u4")]) + 1)).tolist()
            if len(ends) == len(part):
                self.pieces.now.update([(x, raw[a:b]) for x, a, b in zip(part, [0, *ends], ends)])
            else:
                self.pieces.now.update(zip(part, self._ids(part), strict=True))

    def _learn(self, fresh: list[bytes]) -> list[bytes]:
        """The ids of new words, in their order."""
        lines = b"\n".join(fresh).decode("utf-8", "replace")
        texts = lines.split("\n")
        places = [x.start() for x in self.rules[1].finditer(lines)]
        if not places:
            return self._cut(texts)
        ends = np.cumsum([len(x) + 1 for x in texts])
        odd = np.zeros(len(texts), bool)
        odd[np.searchsorted(ends, places, side="right")] = True
        whole = iter(self._ids([x for x, o in zip(texts, odd, strict=True) if o]))
        plain = iter(self._cut([x for x, o in zip(texts, odd, strict=True) if not o]))
        return [next(whole if o else plain) for o in odd]

    def _cut(self, texts: list[str]) -> list[bytes]:
        """Plain words are cut and looked up together, one in each line."""
        parts = self.rules[0].findall("\n".join(texts).lower())
        if parts.count("\n") != len(texts) - 1:  # no words, or pieces go on beyond a line
            return self._ids(texts)
        self._learn_pieces(self.pieces.missing(set(parts) - {"\n"}))
        known = self.pieces.now
        known["\n"] = _BREAK
        return b"".join(map(known.__getitem__, parts)).split(_BREAK)

    def _words(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of the words of `raw`, which ends with WIDE spaces; the number of ids of each; the ids."""
        data = np.frombuffer(raw, np.uint8)
        starts, ends, _ = textkit.words(data, np.array([0, len(data)]))
        known, sizes = self.words, ends - starts
        keys, place = known.keys_of(raw, starts, sizes)
        there = sizes <= WIDE
        for held, key in zip(known.keys, keys, strict=True):
            there &= held[place] == key
        at, number = known.at[place], known.size[place]
        new = np.flatnonzero(~there)
        if len(new):
            words = [raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)]
            index = {x: i for i, x in enumerate(dict.fromkeys(words))}
            which = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
            at[new], number[new] = (x[which] for x in known.hold(self._learn(list(index))))
            short = new[sizes[new] <= WIDE]
            known.note([x[short] for x in keys], place[short], at[short], number[short])
        where = np.repeat(at - np.cumsum(number) + number, number)
        where += np.arange(len(where))
        ids = known.ids[where]
        known.forget()
        return starts, number, ids

    def encode_all(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each UTF-8 text."""
        if not self.rules:
            return [np.frombuffer(x, "<u4") for x in self._ids([t.decode("utf-8", "replace") for t in texts])]
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held, size = [], 0

        def flush() -> None:
            starts, number, ids = self._words(b" ".join([*(x for _, x in held), b" " * WIDE]))
            begins = np.cumsum([0, *(len(x) + 1 for _, x in held)])
            cuts = np.concatenate([[0], np.cumsum(number)])[np.searchsorted(starts, begins)].tolist()
            for (i, _), a, b in zip(held, cuts[:-1], cuts[1:], strict=True):
                out[i].append(ids[a:b])

        for i, text in enumerate(texts):
            for part in _slices(text):
                held.append((i, part))
                size += len(part)
                if size >= SLICE:
                    flush()
                    held, size = [], 0
        flush()
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]

    def encode(self, text: bytes) -> np.ndarray:
        return self.encode_all([text])[0]


def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer and its caches for each Python worker."""
    if path not in _state:
        _state[path] = WordTokenizer(path)
    return _state[path]


def _loss(start: int, length: int, prompt: int) -> int:
    return min(length, max(0, start + length - prompt))


def _most(start: int, prompt: int, tokens: float, loss: float) -> int:
    """How many ids from `start` on reach a limit of tokens or of those that bear loss."""
    return int(min(tokens, max(0, prompt - start) + loss))


class Packer:
    """Packs pieces as they come; holds POOL waiting pieces, or as many more as two sequences need."""

    def __init__(self, tokens: int, segments: int, loss: int, first_id: int) -> None:
        self.capacity = np.array([tokens, segments, loss], float)
        self.next_id, self.waiting, self.rows = first_id, [], []
        self.held = 0  # tokens that wait

    def _emit(self, content: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total, prompt in content:
            loss = _loss(start, len(ids), prompt)
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, loss, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1

    def add(self, doc: int, ids: np.ndarray, prompt: int = 0) -> None:
        """`prompt`: how many of the first ids bear no loss."""
        start = 0
        while len(ids) - start >= (whole := _most(start, prompt, self.capacity[0], self.capacity[2])):
            self._emit([(doc, start, ids[start : start + whole], len(ids), prompt)])
            start += whole
        if start < len(ids):
            self._wait(doc, start, ids[start:], len(ids), prompt)
            self.held += len(ids) - start
        if len(self.waiting) >= POOL and self.held >= 2 * self.capacity[0]:
            while len(self.waiting) > POOL // 2 and self.held >= self.capacity[0]:
                self._fill()

    def _wait(self, doc: int, start: int, ids: np.ndarray, total: int, prompt: int) -> None:
        """Demands of a piece are one number: tokens in the high bits, tokens that bear loss in the low ones."""
        self.waiting.append((doc, start, ids, total, prompt, len(ids) << 32 | _loss(start, len(ids), prompt)))

    def _fill(self, room: int | None = None) -> None:
        """Close one sequence of `room` tokens: whole pieces by dot product, then one cut to fit."""
        pool = self.waiting
        demand = np.array([p[5] for p in pool], np.int64)
        left = self.capacity.copy()
        left[0] = room or left[0]
        # pieces of equal demand are one kind
        queue = np.argsort(demand, kind="stable")
        told, ahead, number = np.unique(demand[queue], return_index=True, return_counts=True)
        kinds = np.stack([told >> 32, np.ones_like(told), told & 0xFFFFFFFF], 1).astype(float)
        weight = kinds / self.capacity
        free, content = np.ones(len(pool), bool), []
        while True:
            fits = (number > 0) & (kinds <= left).all(axis=1)
            if not fits.any():
                break
            best = int(np.argmax(np.where(fits, weight @ (left / self.capacity), -1.0)))
            piece = int(queue[ahead[best]])
            ahead[best] += 1
            number[best] -= 1
            content.append(pool[piece][:5])
            free[piece] = False
            left -= kinds[best]
        kept = [p for p, f in zip(pool, free, strict=True) if f]
        if kept and left[0] >= 1 and left[1] >= 1:
            doc, start, ids, total, prompt, _ = kept.pop(0)
            gap = min(_most(start, prompt, left[0], left[2]), len(ids) - 1)
            if gap > 0:
                content.append((doc, start, ids[:gap], total, prompt))
            self.waiting = kept
            self._wait(doc, start + gap, ids[gap:], total, prompt)
        self.waiting = kept
        self.held -= sum(len(x[2]) for x in content)
        self._emit(content)

    def close(self) -> None:
        """Pack what waits; the last tokens go to sequences of falling powers of two, which need no padding."""
        most = int(self.capacity[0])
        while self.waiting:
            rest = sum(len(p[2]) for p in self.waiting)
            self._fill(most if rest >= most else 1 << (rest.bit_length() - 1))

    def drain(self) -> pa.RecordBatch | None:
        if not self.rows:
            return None
        rows, self.rows = self.rows, []
        return textkit.batch(PIECES, *(list(x) for x in zip(*rows, strict=True)))


def pack(
    docs: DataFrame, encode: Callable[[], Callable[[list[bytes]], list[np.ndarray]]], tokens: int = TOKENS, segments: int | None = None,
    loss_tokens: int | None = None, end_id: int = END_ID, prompt: str | None = None,
) -> DataFrame:
    """Pack all texts of `docs` (doc_id, text) into sequences; one row for each piece.

    `encode` makes, on the worker, a function from UTF-8 texts to their ids; `end_id` closes each
    document. Limits: `tokens`, `segments` (pieces) and `loss_tokens` of a sequence, the last two
    no tighter than the first unless given; the column
    `prompt`, if named, holds the text before the response, whose ids bear no loss (null: none). A sequence that is not full holds a power of two of tokens, at
    most a few in each task, so there is no padding; only a binding segment limit leaves any.
    A null or empty text is its end id alone; repeated rows are packed each on their own; no
    rows give no rows. Sequence ids are unique and follow from the partition, so a task that
    runs again gives the same rows.
    """
    piece_limit, loss_limit = segments or tokens, tokens if loss_tokens is None else loss_tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = encode()
        packer = Packer(tokens, piece_limit, loss_limit, TaskContext.get().partitionId() << 36)
        end = np.array([end_id], np.uint32)
        for rows in batches:
            ids = rows.column(0).to_pylist()
            data, offsets = textkit.byte_column(rows.column(1))
            raw = data.tobytes()
            for a, b in textkit.chunks(offsets):
                heads = to_ids([(p or "").encode() for p in rows.column(2).slice(a, b - a).to_pylist()]) if prompt else [end[:0]] * (b - a)
                bodies = to_ids([raw[offsets[i] : offsets[i + 1]] for i in range(a, b)])
                for doc, head, body in zip(ids[a:b], heads, bodies, strict=True):
                    packer.add(doc, np.concatenate([head, body, end]), len(head))
                    if len(packer.rows) >= 4096:
                        yield packer.drain()
        packer.close()
        if (rest := packer.drain()) is not None:
            yield rest

    return docs.select("doc_id", "text", *([prompt] if prompt else [])).mapInArrow(run, PIECES)


def pack_words(docs: DataFrame, path: str, **limits) -> DataFrame:
    """`pack` with a tokenizer file, read on each worker; it is fastest if the file drops white space and case."""
    return pack(docs, lambda: word_tokenizer(path).encode_all, **limits)
