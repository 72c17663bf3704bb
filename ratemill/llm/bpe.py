"""Byte-level BPE by speculation and verification (operator 5).

A block of texts is handled as one array. Word borders come from character classes, equal words
are found by hash and encoded once. For each distinct word a greedy longest match over the
vocabulary proposes tokens. The proposal is the BPE result exactly if every two neighbours are
compatible, that is, if no merge across their border would have come before the merges that
build the two tokens; this is tested for all pairs at once. Only words with an incompatible pair
go through the merges one by one. The tokens of a block are decoded again and compared with its
bytes, so that two words of equal hash cannot pass for one another.

Null text is empty and has no tokens. Repeated rows are encoded one by one; an empty table gives
no rows; extra columns are left out, whatever their names. Texts of any length are cut, for memory only, at single
spaces or line ends between other characters, where a word always ends.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ratemill.llm.segments import gather, text_bytes

BLOCK_BYTES = 1 << 21
KNOWN_BITS, KNOWN_IDS = 20, 6
NEVER = np.int32(2**31 - 1)
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
# The code points that count as white space, and the endings split off after an
# apostrophe.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ONE_LETTER_ENDINGS = "stmd"
TWO_LETTER_ENDINGS = ("re", "ve", "ll")

_loaded: dict[str, ByteBpe] = {}


def default_vocabulary() -> str:
    """The vocabulary that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def load(path: str) -> ByteBpe:
    """The tokenizer of a vocabulary file, read once in each worker."""
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]


def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[WHITE] = SPACE
    return table


def _byte_of_char() -> dict[str, int]:
    """Vocabulary files write a byte as itself if it is printable, else as a character from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Lookup:
    """Whole-number keys to values in a hash table of arrays, at most an eighth full; -1 if missing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(8 * max(1, len(keys))).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, np.int32)
        keys, first = np.unique(keys, return_index=True)
        values = values[first]
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] < 0
            _, one = np.unique(slot, return_index=True)
            take = one[free[one]]
            self.keys[slot[take]], self.values[slot[take]] = keys[take], values[take]
            rest = np.ones(len(keys), bool)
            rest[take] = False
            keys, values, slot = keys[rest], values[rest], (slot[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        wanted = np.ascontiguousarray(wanted, np.int64)
        slot = self._slot(wanted)
        there = self.keys[slot]
        out = np.where(there == wanted, self.values[slot], np.int32(-1))
        rows = np.flatnonzero((there != wanted) & (there >= 0))
        slot = slot[rows]
        while len(rows):
            slot = (slot + 1) & self.mask
            there = self.keys[slot]
            hit = there == wanted[rows]
            out[rows[hit]] = self.values[slot[hit]]
            on = ~hit & (there >= 0)
            rows, slot = rows[on], slot[on]
        return out


class ByteBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._refuse_other_kinds(spec)
        vocab, byte_of = spec["model"]["vocab"], _byte_of_char()
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *added.values()]) + 1
        self.tokens = [b""] * size
        for text, i in vocab.items():
            if text not in added:
                self.tokens[i] = bytes(byte_of[c] for c in text)
        for text, i in added.items():
            self.tokens[i] = text.encode()
        self.special = {text.encode(): i for text, i in added.items()}
        self.pool, self.starts, self.lengths = _pool(self.tokens)
        self.decimals, self.decimal_starts, self.decimal_lengths = _pool([b"%d," % i for i in range(size)])

        self.byte_id = np.full(256, -1, np.int32)
        for i, raw in enumerate(self.tokens):
            if len(raw) == 1:
                self.byte_id[raw[0]] = i
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        keys = (self.left << 32) | self.right
        self.rank = _Lookup(keys, np.arange(len(pairs)))
        self.rank_of = dict(zip(keys.tolist(), range(len(pairs))))
        self.classes = _classes()
        self.known_key = np.zeros(1 << KNOWN_BITS, np.uint64)
        self.known_count = np.zeros(1 << KNOWN_BITS, np.int8)
        self.known_ids = np.zeros((1 << KNOWN_BITS, KNOWN_IDS), np.int32)
        usable = self._reachable(set(added.values()))
        self._spines()
        self._trie(usable)

    @staticmethod
    def _refuse_other_kinds(spec: dict) -> None:
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        plain_added = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in spec["added_tokens"])
        if odd or spec["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True) or not plain_added:
            raise ValueError("not a plain byte-level BPE vocabulary")

    # Tables

    def _reachable(self, added: set[int]) -> np.ndarray:
        """Tokens that their own bytes are merged to; only these may be proposed."""
        ids = np.array([i for i, raw in enumerate(self.tokens) if raw and i not in added])
        flat, counts = self._merge_all(self.pool, self.starts[ids], self.lengths[ids])
        first = flat[np.cumsum(counts) - counts]
        return ids[(counts == 1) & (first == ids)]

    def _spines(self) -> None:
        """Per token the tokens on its right and left border, outermost first, and the rank of the merge that takes each of them in."""
        size = len(self.tokens)
        merge = np.full(size, -1, np.int64)
        merge[self.made[::-1]] = np.arange(len(self.made))[::-1]
        self.border = []
        for part in (self.right, self.left):
            ids, until = [np.arange(size, dtype=np.int64)], [np.full(size, NEVER)]
            while True:
                by = np.where(ids[-1] >= 0, merge[ids[-1]], -1)
                if (by < 0).all():
                    break
                ids.append(np.where(by >= 0, part[by], -1))
                until.append(np.where(by >= 0, by, -1).astype(np.int32))
            self.border.append((ids, until))

    def _trie(self, usable: np.ndarray) -> None:
        step: dict[int, int] = {}
        accepts = [-1]
        for i in usable.tolist():
            node = 0
            for b in self.tokens[i]:
                node = step.setdefault(node << 8 | b, len(accepts))
                if node == len(accepts):
                    accepts.append(-1)
            accepts[node] = i
        self.step = _Lookup(np.fromiter(step, np.int64, len(step)), np.fromiter(step.values(), np.int64, len(step)))
        self.accepts = np.array(accepts, np.int32)

    # Words

    def words(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte starts of the words of some texts that lie one after another, and each text's first word."""
        chars = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        width = 1 + (chars >= 0x80).astype(np.int64) + (chars >= 0x800) + (chars >= 0x10000)
        at_byte = np.cumsum(width) - width
        n = len(chars)
        first = np.zeros(n + 1, bool)
        begins = np.searchsorted(at_byte, offsets[:-1][offsets[:-1] < offsets[1:]])
        first[begins] = True
        first[n] = True
        kind = self.classes[chars]
        change = np.ones(n, bool)
        change[1:] = kind[1:] != kind[:-1]
        change |= first[:-1]
        white = kind == SPACE
        # A blank before other characters belongs to them.
        held = np.zeros(n, bool)
        held[1:] = (chars[:-1] == 32) & ~white[1:]
        held &= ~first[:-1]
        start = change & ~held
        # The last of white space before other characters stands alone or goes to them.
        last_white = white.copy()
        last_white[:-1] &= ~white[1:] & ~first[1:-1]
        last_white[-1:] = False
        start |= last_white
        quote = np.flatnonzero((chars == 39) & start)
        for take, ok in self._endings(chars, first, quote):
            start[quote[ok] + 1] = False
            after = quote[ok] + 1 + take
            start[after[after < n]] = True
        begin = at_byte[start]
        return begin, np.searchsorted(begin, offsets)

    @staticmethod
    def _endings(chars: np.ndarray, first: np.ndarray, quote: np.ndarray) -> list[tuple[int, np.ndarray]]:
        n = len(chars)

        def char(i: np.ndarray) -> np.ndarray:
            inside = i < n
            return np.where(inside, chars[np.minimum(i, n - 1)], 0)

        one, two = char(quote + 1), char(quote + 2)
        first_in = ~first[np.minimum(quote + 1, n)]
        second_in = first_in & ~first[np.minimum(quote + 2, n)]
        single = np.isin(one, [ord(c) for c in ONE_LETTER_ENDINGS]) & first_in
        double = np.zeros(len(quote), bool)
        for a, b in TWO_LETTER_ENDINGS:
            double |= (one == ord(a)) & (two == ord(b)) & second_in
        return [(1, single), (2, double & ~single)]

    @staticmethod
    def _distinct(raw: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of one word of each kind, the kind of every word, and each kind's hash."""
        padded = np.zeros(len(raw) + 16, np.uint8)
        padded[: len(raw)] = raw
        lanes = np.ndarray((len(raw) + 8,), "<u8", padded, strides=(1,))
        key = length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        active, done = np.arange(len(begin)), 0
        while len(active):
            left = np.minimum(length[active] - done, 8).astype(np.uint64)
            part = lanes[begin[active] + done] & (np.uint64(2**64 - 1) >> (np.uint64(64) - left * np.uint64(8)))
            mixed = (key[active] ^ part) * np.uint64(0xD6E8FEB86659FD93)
            key[active] = mixed ^ (mixed >> np.uint64(32))
            done += 8
            active = active[length[active] > done]
        # Words of one hash elect the last of them that was written to their slot.
        bits = max(4, int(2 * len(key)).bit_length())
        slot = (key >> np.uint64(64 - bits)).astype(np.int64)
        table = np.zeros(1 << bits, np.int64)
        chosen = np.empty(len(key), np.int64)
        rows = np.arange(len(key))
        while len(rows):
            table[slot] = rows
            winner = table[slot]
            same = key[winner] == key[rows]
            chosen[rows[same]] = winner[same]
            rows, slot = rows[~same], (slot[~same] + 1) & (len(table) - 1)
        is_chosen = np.zeros(len(key), bool)
        is_chosen[chosen] = True
        index = np.flatnonzero(is_chosen)
        return index, (np.cumsum(is_chosen) - 1)[chosen], key[index]

    # Encoding

    def encode_bytes(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of texts that lie one after another, and the number of each text's ids."""
        if not len(raw):
            return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        begin, text_word = self.words(raw, offsets)
        length = np.diff(begin, append=len(raw))
        index, kind, key = self._distinct(raw, begin, length)
        ids, counts = self._encode_known(raw, begin[index], length[index], key)
        same = length[index][kind] == length
        per_word = counts[kind]
        flat = gather(ids, (np.cumsum(counts) - counts)[kind], per_word)
        if not same.all() or not np.array_equal(self.decode(flat), raw):
            # Two words of one hash: encode each word of the block by itself.
            ids, per_word = self._encode_words(raw, begin, length)
            flat = ids
        ends = np.concatenate([[0], np.cumsum(per_word)])
        return flat, np.diff(ends[text_word])

    def _encode_known(self, raw: np.ndarray, begin: np.ndarray, length: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words seen before come from a table of fixed size in which a later word replaces an earlier one."""
        slot = (key >> np.uint64(64 - KNOWN_BITS)).astype(np.int64)
        counts = np.where(self.known_key[slot] == key, self.known_count[slot], 0).astype(np.int64)
        new = np.flatnonzero(counts == 0)
        ids, n = self._encode_words(raw, begin[new], length[new])
        at = np.arange(len(begin)) * KNOWN_IDS
        source = np.concatenate([self.known_ids[slot].reshape(-1), ids])
        at[new] = len(begin) * KNOWN_IDS + np.cumsum(n) - n
        counts[new] = n
        short = new[n <= KNOWN_IDS]
        rows = slot[short]
        self.known_key[rows] = 0
        column = np.arange(KNOWN_IDS)
        self.known_ids[rows] = source[np.minimum(at[short, None] + column, len(source) - 1)]
        self.known_count[rows] = counts[short]
        self.known_key[rows] = key[short]
        return gather(source, at, counts), counts

    def _encode_words(self, raw: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        word, ids = self._propose(raw, begin, length)
        counts = np.bincount(word, minlength=len(begin))
        good = np.ones(len(begin), bool)
        near = np.flatnonzero(word[1:] == word[:-1])
        pairs, which = np.unique((ids[near].astype(np.int64) << 32) | ids[near + 1], return_inverse=True)
        good[word[near[~self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)[which]]]] = False
        bad = np.flatnonzero(~good)
        if not len(bad):
            return ids, counts
        merged, merged_counts = self._merge_all(raw, begin[bad], length[bad])
        source = np.concatenate([ids, merged])
        at = np.cumsum(counts) - counts
        at[bad] = len(ids) + np.cumsum(merged_counts) - merged_counts
        counts[bad] = merged_counts
        return gather(source, at, counts), counts

    def _propose(self, raw: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match of all words in step: each takes one byte or one token per round."""
        if not len(begin):
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        end = begin + length
        word = np.arange(len(begin))
        at, reach = begin.copy(), begin.copy()
        node = np.zeros(len(begin), np.int64)
        token = np.full(len(begin), -1, np.int32)
        upto = begin.copy()
        found_word, found_id = [], []
        while len(word):
            more = reach < end
            byte = raw[np.minimum(reach, len(raw) - 1)]
            nxt = np.where(more, self.step((node << 8) | byte), -1)
            on = nxt >= 0
            reach += on
            node = np.where(on, nxt, 0)
            accepted = np.where(on, self.accepts[node], -1)
            hit = accepted >= 0
            token = np.where(hit, accepted, token)
            upto = np.where(hit, reach, upto)
            out = ~on
            found_word.append(word[out])
            found_id.append(token[out])
            at = np.where(out, upto, at)
            reach = np.where(out, upto, reach)
            keep = ~out | (at < end)
            if not keep.all():
                word, at, reach, node, token, upto, end = (x[keep] for x in (word, at, reach, node, token, upto, end))
        word = np.concatenate(found_word)
        order = np.argsort(word, kind="stable")
        return word[order], np.concatenate(found_id)[order]

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the two tokens stay as they are side by side.

        A merge across the border needs a token on the right border of the one and a token on
        the left border of the other while both still stand by themselves. At equal rank the
        merge further left comes first.
        """
        good = np.ones(len(left), bool)
        for xs, x_until in zip(*self.border[0]):
            x, xu = xs[left], x_until[left]
            if not (x >= 0).any():
                break
            for ys, y_until in zip(*self.border[1]):
                rows = np.flatnonzero(good & (x >= 0) & (ys[right] >= 0))
                if not len(rows):
                    break
                y, yu = ys[right[rows]], y_until[right[rows]]
                rank = self.rank((x[rows] << 32) | y)
                good[rows[(rank >= 0) & (rank < xu[rows]) & (rank <= yu)]] = False
        return good

    def _merge_all(self, raw: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging, words of like length together."""
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        lower = 0
        for width in (8, 16, 32, 64):
            rows = np.flatnonzero((length > lower) & (length <= width))
            for some in np.array_split(rows, len(rows) * width // (1 << 21) + 1):
                if len(some):
                    out.append((some, *self._merge_short(raw, begin[some], length[some], width)))
            lower = width
        for row in np.flatnonzero(length > lower):
            ids = np.array(self._merge_long(raw[begin[row] : begin[row] + length[row]]), np.int32)
            out.append((np.array([row]), ids, np.array([len(ids)])))
        counts = np.zeros(len(begin), np.int64)
        at = np.zeros(len(begin), np.int64)
        done = 0
        for rows, ids, n in out:
            counts[rows] = n
            at[rows] = done + np.cumsum(n) - n
            done += len(ids)
        source = np.concatenate([ids for _, ids, _ in out]) if out else np.zeros(0, np.int32)
        return gather(source, at, counts), counts

    def _merge_short(self, raw: np.ndarray, begin: np.ndarray, length: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """One merge of each word per round, the lowest rank first, the leftmost of equals."""
        n = len(begin)
        column = np.arange(width)
        place = np.minimum(begin[:, None] + column, len(raw) - 1)
        inside = column < length[:, None]
        ids = np.where(inside, self.byte_id[raw[place]], -1).astype(np.int64)
        follow = np.where(column + 1 < length[:, None], column + 1, -1)
        before = np.broadcast_to(column - 1, (n, width)).copy()
        rank = np.full((n, width), NEVER)
        has = follow >= 0
        rank[has] = self._rank_or_never(ids[:, :-1][has[:, :-1]], ids[:, 1:][has[:, :-1]])
        rows = np.arange(n)
        while len(rows):
            col = rank[rows].argmin(1)
            best = rank[rows, col]
            on = best < NEVER
            rows, col, best = rows[on], col[on], best[on]
            if not len(rows):
                break
            gone = follow[rows, col]
            after = follow[rows, gone]
            ids[rows, col] = self.made[best]
            ids[rows, gone] = -1
            rank[rows, gone] = NEVER
            follow[rows, col] = after
            more = after >= 0
            before[rows[more], after[more]] = col[more]
            rank[rows, col] = NEVER
            rank[rows[more], col[more]] = self._rank_or_never(ids[rows[more], col[more]], ids[rows[more], after[more]])
            prior = before[rows, col]
            some = prior >= 0
            rank[rows[some], prior[some]] = self._rank_or_never(ids[rows[some], prior[some]], ids[rows[some], col[some]])
        left = ids >= 0
        return ids[left].astype(np.int32), left.sum(1)

    def _rank_or_never(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        rank = self.rank((a << 32) | b)
        return np.where(rank >= 0, rank, NEVER)

    def _merge_long(self, raw: np.ndarray) -> list[int]:
        """Exact merging of one long word with a heap of its possible merges."""
        ids = self.byte_id[raw].tolist()
        n = len(ids)
        follow, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = follow[i]
            if j >= 0:
                rank = self.rank_of.get(ids[i] << 32 | ids[j])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        for i in range(n):
            offer(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = follow[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.made[rank]), -1
            follow[i] = follow[j]
            if follow[i] >= 0:
                before[follow[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [i for i in ids if i >= 0]

    def _cut(self, raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, start, end, id): parts of texts in order; the id of an added token, else -1."""
        body = raw.tobytes() if len(raw) else b""
        has_special = any(s in body for s in self.special)
        for i in range(len(offsets) - 1):
            lo, hi = int(offsets[i]), int(offsets[i + 1])
            marks = []
            if has_special:
                marks = _occurrences(body, lo, hi, self.special)
            for start, stop, token in [*marks, (hi, hi, -1)]:
                while start - lo > BLOCK_BYTES:
                    cut = _word_end(body, lo, lo + BLOCK_BYTES, start)
                    yield i, lo, cut, -1
                    lo = cut
                yield i, lo, start, -1
                if token >= 0:
                    yield i, start, stop, token
                lo = stop

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, ids per row) for consecutive rows of a text column.

        Rows come in blocks of bounded size; a row longer than a block comes alone.
        """
        raw, offsets = text_bytes(column)
        parts: list[tuple[int, int, int, int]] = []
        done_rows, kept_ids, kept_rows = 0, [], []

        def flush() -> None:
            if parts:
                lo = parts[0][1]
                bounds = np.array([p[1] for p in parts] + [parts[-1][2]], np.int64) - lo
                # An added token is no text: it is cut out of the words and put back as one id.
                text = [k for k, p in enumerate(parts) if p[3] < 0]
                if len(text) == len(parts):
                    ids, counts = self.encode_bytes(raw[lo : parts[-1][2]], bounds)
                else:
                    got = [self.encode_bytes(raw[p[1] : p[2]], np.array([0, p[2] - p[1]]))[0] if p[3] < 0 else np.array([p[3]], np.int32) for p in parts]
                    ids, counts = np.concatenate(got), np.array([len(g) for g in got])
                kept_ids.append(ids)
                kept_rows.append(np.repeat([p[0] for p in parts], counts))
                parts.clear()

        def ready(upto: int) -> tuple[int, np.ndarray, np.ndarray]:
            ids = np.concatenate(kept_ids) if kept_ids else np.zeros(0, np.int32)
            rows = np.concatenate(kept_rows) if kept_rows else np.zeros(0, np.int64)
            kept_ids.clear()
            kept_rows.clear()
            return done_rows, ids, np.bincount(rows - done_rows, minlength=upto - done_rows)

        size, row = 0, 0
        for part in self._cut(raw, offsets):
            if part[0] != row:
                row = part[0]
                if size >= BLOCK_BYTES:
                    flush()
                    yield ready(row)
                    done_rows, size = row, 0
            if size and size + part[2] - part[1] > 2 * BLOCK_BYTES:
                flush()
            parts.append(part)
            size += part[2] - part[1]
        flush()
        if len(offsets) - 1 > done_rows:
            yield ready(len(offsets) - 1)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens."""
        return gather(self.pool, self.starts[ids], self.lengths[ids])

    def decimal(self, ids: np.ndarray) -> np.ndarray:
        """The ids as decimal text, a comma after each."""
        return gather(self.decimals, self.decimal_starts[ids], self.decimal_lengths[ids])


def _pool(items: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(x) for x in items], np.int64)
    return np.frombuffer(b"".join(items), np.uint8), np.cumsum(lengths) - lengths, lengths


def _occurrences(body: bytes, lo: int, hi: int, special: dict[bytes, int]) -> list[tuple[int, int, int]]:
    found = []
    while True:
        here = [(at, -len(s), s) for s in special if (at := body.find(s, lo, hi)) >= 0]
        if not here:
            return found
        at, _, s = min(here)
        lo = at + len(s)
        found.append((at, lo, special[s]))


def _word_end(body: bytes, lo: int, want: int, hi: int) -> int:
    """The last place up to ``want``, else the first after it, where a word surely ends."""
    blank = b" \t\n\x0b\x0c\r"

    def sure(at: int) -> bool:
        # Both neighbours are printable ASCII, so neither is white space.
        return lo < at < hi - 1 and 33 <= body[at - 1] < 127 and 33 <= body[at + 1] < 127

    at = want
    while (at := max(body.rfind(b" ", lo, at), body.rfind(b"\n", lo, at))) > lo:
        if sure(at):
            return at
    at = want - 1
    while at < hi - 1:
        at += 1
        if body[at] in blank and sure(at):
            return at
    return hi


def encoded_digests(docs: DataFrame, id_col: str, text_col: str, vocabulary: str) -> DataFrame:
    """Number of tokens, digest of the ids and digest of the decoded text of every row."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for batch in batches:
            n_tokens, of_ids, of_text = [], [], []
            for _, ids, counts in bpe.encode(batch.column(1)):
                text, number = bpe.decode(ids), bpe.decimal(ids)
                ends = np.concatenate([[0], np.cumsum(counts)])
                text_ends = np.concatenate([[0], np.cumsum(bpe.lengths[ids])])[ends].tolist()
                number_ends = np.concatenate([[0], np.cumsum(bpe.decimal_lengths[ids])])[ends].tolist()
                for i in range(len(counts)):
                    of_text.append(hashlib.sha256(_valid(text[text_ends[i] : text_ends[i + 1]])).hexdigest())
                    of_ids.append(hashlib.sha256(number[number_ends[i] : max(number_ends[i], number_ends[i + 1] - 1)]).hexdigest())
                n_tokens += counts.tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_tokens, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(docs[id_col].alias("key"), docs[text_col].alias("text"))
    out = rows.mapInArrow(digests, f"key {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("key", id_col)


def _valid(raw: np.ndarray) -> bytes:
    """As the decoder gives it: bytes that are no UTF-8 become replacement characters."""
    data = raw.tobytes()
    try:
        data.decode("utf-8")
        return data
    except UnicodeDecodeError:
        return data.decode("utf-8", "replace").encode()
