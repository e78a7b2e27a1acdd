"""SentencePiece encoding and decoding by vectorised merge rounds.

The symbols of all different words of a slice lie in one flat array.  A round finds
the pair of lowest rank in each word, merges its leftmost occurrences that don't
overlap in all words at once, and closes the gaps.  Words without a pair left are put
aside; the rounds end when all are.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm import ship
from rosterflow.llm.batches import byte_slices, held, list_array, ragged, texts

SPACE = "▁"
NONE = np.int32(2**31 - 1)


class PairTable:
    """Rank and result of a pair of symbols: open addressing in flat arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, result: np.ndarray):
        self.bits = max(10, int(len(left)).bit_length() + 3)
        size = 1 << self.bits
        self.keys = np.full(size, -1, dtype=np.int64)
        self.rank = np.full(size, NONE, dtype=np.int32)
        self.result = np.full(size, -1, dtype=np.int32)
        keys = self.key(left, right)
        slots = self.slot(keys)
        todo = np.arange(len(keys))
        self.probes = 0
        while len(todo):
            self.probes += 1
            free = todo[self.keys[slots[todo]] < 0]
            self.keys[slots[free]] = keys[free]  # of several for one slot, the last stays
            done = self.keys[slots[todo]] == keys[todo]
            put = todo[done]
            self.rank[slots[put]], self.result[slots[put]] = rank[put], result[put]
            todo = todo[~done]
            slots[todo] = (slots[todo] + 1) & (size - 1)

    @staticmethod
    def key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.int64) << 32 | right.astype(np.int64)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks, ``NONE`` where the pair isn't merged, and results."""
        keys = self.key(left, right)
        at = self.slot(keys)
        rank = np.full(len(keys), NONE, dtype=np.int32)
        result = np.full(len(keys), -1, dtype=np.int32)
        todo = np.arange(len(keys))
        for _ in range(self.probes):
            slots = at[todo]
            there = self.keys[slots]
            hit = there == keys[todo]
            got = todo[hit]
            rank[got], result[got] = self.rank[slots[hit]], self.result[slots[hit]]
            more = ~hit & (there >= 0)
            todo = todo[more]
            if not len(todo):
                break
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)
        return rank, result


class PieceModel:
    """The pieces of a SentencePiece BPE model with byte fallback, as arrays.

    Read with the ``sentencepiece`` library: pieces, scores and kinds alone; encoding
    and decoding are done here.  Only models that leave text as it is are taken: with
    a space put first, spaces as U+2581, and nothing else normalised.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.normalize("  Ａﬁ\n é ") != "▁▁▁Ａﬁ\n▁é▁":
            raise ValueError("the model normalises text; only the identity with a space put first is built")
        self.size = size = model.vocab_size()
        self.end_id, self.start_id, self.unknown_id = model.eos_id(), model.bos_id(), model.unk_id()
        pieces = [model.id_to_piece(i) for i in range(size)]
        is_byte = [model.is_byte(i) for i in range(size)]
        silent = [model.is_control(i) for i in range(size)]
        normal = {p: i for i, p in enumerate(pieces) if not (is_byte[i] or silent[i] or model.is_unknown(i))}
        scores = {i: model.get_score(i) for i in normal.values()}
        ranks = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.byte_ids = np.full(256, self.unknown_id, dtype=np.int32)
        for i in range(size):
            if is_byte[i]:
                self.byte_ids[int(pieces[i][3:5], 16)] = i
        self.has_bytes = sum(is_byte) == 256
        # a character that is no piece, but part of one, is a symbol too: its number is size + code point
        self.char_ids = np.arange(0x110000, dtype=np.int32) + size
        for p, i in normal.items():
            if len(p) == 1:
                self.char_ids[ord(p)] = i
        symbol = lambda s: normal.get(s, size + ord(s) if len(s) == 1 else None)
        pairs = [
            (symbol(p[:k]), symbol(p[k:]), ranks[scores[i]], i)
            for p, i in normal.items() for k in range(1, len(p))
            if symbol(p[:k]) is not None and symbol(p[k:]) is not None
        ]
        self.pairs = PairTable(*(np.array(c, dtype=np.int32) for c in zip(*pairs, strict=True)))
        self.words = self.word_pattern(normal, ranks, scores)
        # what decoding writes for each id
        self.is_byte = np.array(is_byte)
        self.byte_of = np.zeros(size, dtype=np.uint8)
        self.byte_of[self.byte_ids[self.byte_ids != self.unknown_id]] = np.flatnonzero(self.byte_ids != self.unknown_id)
        written = [
            b"" if silent[i] else bytes([self.byte_of[i]]) if is_byte[i] else " ⁇ ".encode() if i == self.unknown_id
            else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.out_length = np.array([len(w) for w in written], dtype=np.int64)
        self.out_start = np.cumsum(self.out_length) - self.out_length
        self.out = np.frombuffer(b"".join(written), dtype=np.uint8)
        self.silent = np.array(silent)
        self.spaced = np.array([p.startswith(SPACE) and not silent[i] for i, p in enumerate(pieces)])

    @staticmethod
    def word_pattern(normal: dict[str, int], ranks: dict, scores: dict) -> re.Pattern:
        """Where a text may be cut without changing its pieces."""
        if any(SPACE in p.lstrip(SPACE) for p in normal):
            return re.compile(r".+", re.DOTALL)
        runs = {len(p): scores[i] for p, i in normal.items() if not p.strip(SPACE) and len(p) > 1}
        longest = max(runs, default=0)
        tiled = (
            longest and len(set(runs.values())) == 1 and tiles(set(runs), longest)
            and ranks[next(iter(runs.values()))] == len(ranks) - 1
            and not any(p.startswith(SPACE * 2) and p.strip(SPACE) for p in normal)
        )
        if not tiled:
            return re.compile(rf"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        # pieces of spaces alone are merged last, all with one rank: a run is tiled from the left by the longest
        return re.compile(rf"{SPACE}{{{longest}}}(?={SPACE})|{SPACE}{{1,{longest}}}[^{SPACE}]*|[^{SPACE}]+")

    def split(self, text: str) -> list[str]:
        """The words of a text, with its spaces as U+2581 and one more in front; none if it is empty."""
        return self.words.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of different words and the number of ids of each."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        symbols = self.char_ids[codes]
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        symbols, word = self.merge(symbols, word)
        return self.bytes_for_unknown(symbols, word, len(words))

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds until no word has a pair; symbols and their words, by word."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank, result = self.pair_ranks(symbols, word)
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(symbols)])
            least_at = np.repeat(least, sizes)
            idle = least_at == NONE
            if idle.any():
                done.append((symbols[idle], word[idle]))
                live = ~idle
                symbols, word, rank, result, least_at = symbols[live], word[live], rank[live], result[live], least_at[live]
                if not len(symbols):
                    break
            chosen = self.leftmost(rank == least_at)
            chosen = self.checked(symbols, word, rank, result, chosen)
            at = np.flatnonzero(chosen)
            symbols[at] = result[at]
            gone = np.zeros(len(symbols), dtype=bool)
            gone[at + 1] = True
            fresh = np.zeros(len(symbols), dtype=bool)
            fresh[at] = True
            stay = ~gone
            symbols, word, rank, result, fresh = symbols[stay], word[stay], rank[stay], result[stay], fresh[stay]
            again = np.flatnonzero(fresh | np.r_[fresh[1:], False])
            last = again == len(symbols) - 1
            inner = again[~last]
            rank[again[last]] = NONE
            same = word[inner] == word[inner + 1]
            rank[inner[~same]] = NONE
            inner = inner[same]
            rank[inner], result[inner] = self.pairs.find(symbols[inner], symbols[inner + 1])
        if not done:
            return symbols, word
        symbols, word = np.concatenate([s for s, _ in done]), np.concatenate([w for _, w in done])
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def pair_ranks(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each symbol with the next one of its word."""
        rank = np.full(len(symbols), NONE, dtype=np.int32)
        result = np.full(len(symbols), -1, dtype=np.int32)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner], result[inner] = self.pairs.find(symbols[inner], symbols[inner + 1])
        return rank, result

    @staticmethod
    def leftmost(wanted: np.ndarray) -> np.ndarray:
        """Of adjacent wanted pairs, which overlap, every other one from the left."""
        at = np.flatnonzero(wanted)
        first = np.r_[True, at[1:] != at[:-1] + 1]
        run_start = at[first][np.cumsum(first) - 1]
        chosen = np.zeros(len(wanted), dtype=bool)
        chosen[at[(at - run_start) % 2 == 0]] = True
        return chosen

    def checked(self, symbols, word, rank, result, chosen) -> np.ndarray:
        """Leave one merge to each word in which a merge makes a pair that comes before the next merge.

        One at a time, such a pair would be merged first.  Merging all at once
        is right elsewhere, since pairs of one rank go from left to right.
        """
        at = np.flatnonzero(chosen)
        owner = word[at]
        several = np.zeros(len(at), dtype=bool)
        several[1:] = owner[1:] == owner[:-1]
        several[:-1] |= several[1:]
        k = at[several]
        if not len(k):
            return chosen
        made, limit = result[k], rank[k]
        worse = np.zeros(len(k), dtype=bool)
        after = np.flatnonzero((k + 2 < len(symbols)) & (word[np.minimum(k + 2, len(word) - 1)] == word[k]))
        worse[after] |= self.pairs.find(made[after], symbols[k[after] + 2])[0] <= limit[after]
        before = np.flatnonzero((k > 0) & (word[np.maximum(k - 1, 0)] == word[k]))
        worse[before] |= self.pairs.find(symbols[k[before] - 1], made[before])[0] <= limit[before]
        joined = before[(k[before] > 1)]
        joined = joined[chosen[k[joined] - 2] & (word[k[joined] - 2] == word[k[joined]])]
        worse[joined] |= self.pairs.find(result[k[joined] - 2], made[joined])[0] <= limit[joined]
        if worse.any():
            bad = np.isin(owner, word[k[worse]])
            later = np.zeros(len(at), dtype=bool)
            later[1:] = owner[1:] == owner[:-1]
            chosen[at[bad & later]] = False
        return chosen

    def bytes_for_unknown(self, symbols: np.ndarray, word: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Write characters that are no piece as the pieces of their UTF-8 bytes."""
        code = symbols.astype(np.int64) - self.size
        unknown = code >= 0
        if unknown.any():
            if self.has_bytes:
                width = np.where(unknown, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000), 1)
                nth = ragged(np.zeros(len(width), dtype=np.int64), width)
                code, width_of, was = np.repeat(code, width), np.repeat(width, width), np.repeat(unknown, width)
                symbols, word = np.repeat(symbols, width), np.repeat(word, width)
                lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[width_of]
                bits = np.where(was, code, 0) >> (6 * (width_of - 1 - nth))
                byte = np.where(nth == 0, lead | bits, 0x80 | (bits & 0x3F)) & 0xFF
                symbols = np.where(was, self.byte_ids[byte], symbols).astype(np.int32)
            else:
                symbols = np.where(unknown, self.unknown_id, symbols).astype(np.int32)
        return symbols, np.bincount(word, minlength=n_words)

    def encode(self, values: list[str], end: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of texts, each with the end id, and the number of ids of each."""
        number: dict[str, int] = {}
        split = [self.split(v) for v in values]
        place = np.array([number.setdefault(w, len(number)) for s in split for w in s], dtype=np.int64)
        counts = np.array([len(s) for s in split], dtype=np.int64)
        ids, sizes = self.encode_words(list(number)) if number else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        starts = np.cumsum(sizes) - sizes
        flat = ids[ragged(starts[place], sizes[place])]
        ends = np.cumsum(counts)
        passed = np.r_[0, np.cumsum(sizes[place])]
        lengths = passed[ends] - passed[ends - counts]
        if end:
            flat = np.insert(flat, np.cumsum(lengths), self.end_id)
            lengths = lengths + 1
        return flat, lengths

    def decode(self, flat: np.ndarray, lengths: np.ndarray) -> list[str]:
        """The texts of ids: spaces for U+2581, but for the one put first, and bytes for byte pieces.

        Bytes that are no UTF-8 become U+FFFD, one for each byte.  An id outside the model raises.
        """
        if len(flat) and (flat.min() < 0 or flat.max() >= self.size):
            raise ValueError("an id lies outside the vocabulary")
        widths = self.out_length[flat]
        data = self.out[ragged(self.out_start[flat], widths)].tobytes()
        ends = np.cumsum(lengths)
        stop = np.r_[0, np.cumsum(widths)]
        # the first id that is written loses the space put in front
        loud = np.flatnonzero(~self.silent[flat]) if len(flat) else np.zeros(0, np.int64)
        found = np.searchsorted(loud, ends - lengths)
        found = np.append(loud, len(flat))[found]
        # a silent piece ends a run of byte pieces, so that its bytes aren't joined with the next ones
        torn = np.flatnonzero(self.is_byte[flat[:-1]] & self.silent[flat[1:]])
        apart = set(np.searchsorted(ends, torn, side="right").tolist())
        drop = np.zeros(len(lengths), dtype=np.int64)
        has = found < ends
        drop[has] = self.spaced[flat[found[has]]]
        out = []
        for i, (a, b, cut, first, last) in enumerate(zip(
            stop[ends - lengths].tolist(), stop[ends].tolist(), drop.tolist(), (ends - lengths).tolist(), ends.tolist(), strict=True
        )):
            try:
                if i in apart:
                    out.append(self.decode_broken(flat[first:last])[cut:])
                    continue
                out.append(data[a + cut : b].decode())
            except UnicodeDecodeError:
                out.append(self.decode_broken(flat[first:last])[cut:])
        return out

    def decode_broken(self, ids: np.ndarray) -> str:
        """Where byte pieces form no UTF-8: runs of them are decoded by themselves."""
        parts, pending = [], bytearray()
        for i in ids.tolist():
            if self.is_byte[i]:
                pending.append(int(self.byte_of[i]))
                continue
            parts.append(lenient(bytes(pending)))
            pending.clear()
            start, width = int(self.out_start[i]), int(self.out_length[i])
            parts.append(self.out[start : start + width].tobytes().decode())
        return "".join(parts) + lenient(bytes(pending))


def lenient(data: bytes) -> str:
    """UTF-8 with U+FFFD for each byte that isn't part of a character."""
    out = []
    while data:
        try:
            return "".join(out) + data.decode()
        except UnicodeDecodeError as error:
            out.append(data[: error.start].decode() + "�")
            data = data[error.start + 1 :]
    return "".join(out)


def tiles(lengths: set[int], longest: int) -> bool:
    """Whether merging runs of one character from the left, into ``lengths``, makes as many of the longest as fit."""
    for n in range(longest, 3 * longest + 1):
        run = [1] * n
        while at := next((i + 1 for i in range(len(run) - 1) if run[i] + run[i + 1] in lengths), 0):
            run[at - 1 : at + 1] = [run[at - 1] + run[at]]
        if run[: n // longest] != [longest] * (n // longest):
            return False
    return True


def piece_model(path: str) -> Callable[[], PieceModel]:
    """A function that gives the model, loaded once in each Python worker."""
    return lambda: held("pieces", (path,), lambda: PieceModel(path))


def encode_pieces(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", end: bool = True) -> DataFrame:
    """``key``, ``ids`` of every whole text, null being empty; with the end id last.

    Rows are handled one by one: repeated rows get equal ids, an empty frame gives no rows.
    """
    ship(df.sparkSession)
    picked = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = picked.schema["key"].dataType.simpleString()
    model = piece_model(path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches, "text"):
            flat, lengths = model().encode(texts(part, "text"), end)
            yield pa.RecordBatch.from_arrays([part.column("key"), list_array(flat, lengths, pa.int32())], ["key", "ids"])

    return picked.mapInArrow(encode, f"key {kind}, ids array<int>")


def decode_pieces(df: DataFrame, path: str, key: str = "key", ids: str = "ids", keep_ids: bool = True) -> DataFrame:
    """``key``, ``ids``, ``text`` of lists of ids; a null or empty list gives the empty text.

    A null among the ids is the unknown piece.
    """
    ship(df.sparkSession)
    picked = df.select(F.col(key).alias("key"), F.col(ids).cast("array<int>").alias("ids"))
    kind = picked.schema["key"].dataType.simpleString()
    model = piece_model(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                column = part.column("ids")
                lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                flat = column.flatten().fill_null(model().unknown_id).to_numpy(zero_copy_only=False)
                decoded = pa.array(model().decode(flat, lengths), pa.string())
                columns = [part.column("key"), *([column] if keep_ids else []), decoded]
                yield pa.RecordBatch.from_arrays(columns, ["key", *(["ids"] if keep_ids else []), "text"])

    return picked.mapInArrow(decode, f"key {kind}, " + ("ids array<int>, " if keep_ids else "") + "text string")
