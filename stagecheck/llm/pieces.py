"""Operator 1: SentencePiece encoding that keeps source offsets, and decoding.

A text is normalised by longest-prefix steps through the model's compiled character map, and
every normalised byte remembers the source byte it came from. Byte-pair merging then runs on
stretches that no piece can cross, and each piece is projected through that alignment to a
span of bytes of the original text.

Only rows move: the model (a file of fixed, known size) is broadcast, and each task keeps a
bounded memory of stretches it has already encoded. Nothing is shuffled.

Defined cases: a null text counts as empty and gives the begin and end ids only; very long
stretches are merged with a heap (n log n) and not remembered; repeated rows are encoded each on
its own; other columns are passed by. Supported models: byte-pair models with byte fallback and
without user-defined or unused pieces; others raise ValueError.
"""

from __future__ import annotations

import array
import hashlib
import heapq
import itertools
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stagecheck.llm.common import texts_of

SPACE = "▁"
NEVER = float("inf")
REMEMBERED = 200_000  # stretches a task keeps
TOGETHER = 1_000_000  # characters of text whose new stretches are merged together
LONG = 48  # characters; longer stretches are not kept, and merged with a heap


class CharacterMap:
    """The compiled map of a model: a double-array trie over source bytes, and its replacements.

    Layout: the trie's size in bytes (32 bits), the trie's 32-bit units, then replacements ended
    by zero bytes. The value of a key is where its replacement starts.
    """

    def __init__(self, blob: bytes):
        self.units: list[int] = []
        self.replacements = b""
        if blob:
            size = int.from_bytes(blob[:4], "little")
            self.units = np.frombuffer(blob[4 : 4 + size], dtype="<u4").tolist()
            self.replacements = blob[4 + size :]

    @staticmethod
    def _step(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, source: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest key that starts at ``at``."""
        units = self.units
        if not units:
            return None
        found, node = None, self._step(units[0])
        for i in range(at, len(source)):
            node ^= source[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != source[i]:
                break
            node ^= self._step(unit)
            if unit >> 8 & 1:
                found = units[node] & 0x7FFFFFFF, i + 1 - at
        if found is None:
            return None
        start = found[0]
        return self.replacements[start : self.replacements.index(b"\0", start)], found[1]


def _character_size(lead: int) -> int:
    return 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


def _packed(numbers: list[int]) -> bytes:
    return array.array("I", numbers).tobytes() if sys.byteorder == "little" else np.array(numbers, "<u4").tobytes()


class _Memory(dict):
    """Encoded words, by the word without its leading space; what is missing is encoded when asked for."""

    def __init__(self, coder: PieceCoder):
        super().__init__()
        self.coder = coder

    def __missing__(self, word: str) -> tuple[bytes, bytes]:
        ids, _, sources = self.coder.encode_stretch(SPACE + word)
        return ids, sources


class PieceCoder:
    """Encodes and decodes single texts with one model."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        trainer, rules = proto.trainer_spec, proto.normalizer_spec
        if trainer.model_type != trainer.BPE or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix:
            raise ValueError("only byte-pair models with byte fallback and leading spaces are supported")
        self.map = CharacterMap(rules.precompiled_charsmap)
        self.rules = rules
        self.raw: set[int] = set()  # ids that stand for single bytes
        self.begin, self.end = trainer.bos_id, trainer.eos_id
        self.ids: dict[str, int] = {}
        self.costs: dict[str, float] = {}
        self.byte_ids = [0] * 256
        surfaces: list[bytes] = []
        self.spaced: set[int] = set()
        for i, piece in enumerate(proto.pieces):
            if piece.type == kinds.NORMAL:
                self.ids[piece.piece], self.costs[piece.piece] = i, -piece.score
                surfaces.append(piece.piece.replace(SPACE, " ").encode())
                if piece.piece.startswith(SPACE):
                    self.spaced.add(i)
            elif piece.type == kinds.BYTE:
                value = int(piece.piece[3:5], 16)
                self.byte_ids[value] = i
                self.raw.add(i)
                surfaces.append(bytes([value]))
            elif piece.type == kinds.CONTROL:
                surfaces.append(b"")
            elif piece.type == kinds.UNKNOWN:
                surfaces.append(trainer.unk_surface.encode())
            else:
                raise ValueError(f"piece {piece.piece!r} is of a kind that is not supported")
        self.surfaces = np.array(surfaces, dtype=object)
        self.sizes = np.array([len(x) for x in surfaces])
        crossing = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        #: Stretches between which no merge is possible: a run of spaces with what follows it.
        self.stretches = None if crossing else re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.plain = not self.map.units and not rules.remove_extra_whitespaces and rules.escape_whitespaces
        #: Whether the words between single spaces can be encoded one by one.
        self.by_word = self.plain and self.stretches is not None and rules.add_dummy_prefix
        self.known = _Memory(self)
        self._list_merges()

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text, and for each of its bytes, and its end, the source byte it came from."""
        if not text:
            return "", np.zeros(1, np.int64)
        return self._normalise_plain(text) if self.plain else self._normalise_mapped(text.encode())

    def _normalise_plain(self, text: str) -> tuple[str, np.ndarray]:
        source = np.frombuffer(text.encode(), dtype=np.uint8)
        sizes = np.where(source == 32, 3, 1)
        origin = np.arange(len(source))
        origin = np.maximum.accumulate(np.where(source & 0xC0 == 0x80, 0, origin))  # a character's bytes start together
        origin = np.append(np.repeat(origin, sizes), len(source))
        spaced = text.replace(" ", SPACE)
        if self.rules.add_dummy_prefix:
            return SPACE + spaced, np.concatenate([np.zeros(3, np.int64), origin])
        return spaced, origin

    def _normalise_mapped(self, source: bytes) -> tuple[str, np.ndarray]:
        rules, space = self.rules, SPACE.encode() if self.rules.escape_whitespaces else b" "
        steps = []  # replacement, start and size in the source
        at = 0
        while at < len(source):
            hit = self.map.longest(source, at)
            if hit is None:
                size = _character_size(source[at])
                hit = source[at : at + size], size
            steps.append((hit[0], at, hit[1]))
            at += hit[1]
        used = 0
        if rules.remove_extra_whitespaces:
            while steps and steps[0][0] == b" ":
                used = steps[0][1] + steps[0][2]
                steps.pop(0)
        if not steps:
            return "", np.array([used])
        out, origin = bytearray(), []
        if rules.add_dummy_prefix:
            out += space
            origin += [used] * len(space)
        after_space = rules.remove_extra_whitespaces
        for replacement, start, size in steps:
            if after_space:
                replacement = replacement.lstrip(b" ")
            if replacement:
                written = replacement.replace(b" ", space)
                out += written
                origin += [start] * len(written)
                after_space = replacement.endswith(b" ")
            after_space = after_space and rules.remove_extra_whitespaces
            used = start + size
        if rules.remove_extra_whitespaces:
            while out.endswith(space):
                used = origin[len(out) - len(space)]
                del out[-len(space) :], origin[len(out) :]
        return out.decode(), np.array([*origin, used])

    def _merged(self, stretch: str) -> list[str]:
        """Symbols after merging the best-scored neighbours, leftmost first among equals."""
        if len(stretch) > LONG:
            return self._merged_long(stretch)
        cost, symbols = self.costs.get, list(stretch)
        costs = [cost(a + b, NEVER) for a, b in itertools.pairwise(symbols)]
        while costs:
            least = min(costs)
            if least == NEVER:
                break
            at = costs.index(least)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            del costs[at]
            if at:
                costs[at - 1] = cost(symbols[at - 1] + symbols[at], NEVER)
            if at < len(costs):
                costs[at] = cost(symbols[at] + symbols[at + 1], NEVER)
        return symbols

    def _merged_long(self, stretch: str) -> list[str]:
        symbols = list(stretch)
        before = list(range(-1, len(symbols) - 1))
        after = list(range(1, len(symbols) + 1))
        queue: list[tuple[float, int, str, str]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right < len(symbols):
                cost = self.costs.get(symbols[left] + symbols[right])
                if cost is not None:
                    heapq.heappush(queue, (cost, left, symbols[left], symbols[right]))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        while queue:
            _, left, first, second = heapq.heappop(queue)
            right = after[left]
            if right >= len(symbols) or symbols[left] != first or symbols[right] != second:
                continue  # one of the two has been merged meanwhile
            symbols[left], symbols[right] = first + second, ""
            after[left] = after[right]
            if after[left] < len(symbols):
                before[after[left]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [s for s in symbols if s]

    def _list_merges(self) -> None:
        """All pairs of symbols that merge, as sorted numbers, with the piece they make. A symbol is numbered by its piece, or its character."""
        self.first_character = len(self.surfaces)
        keys, made = [], []
        for piece, number in self.ids.items():
            for at in range(1, len(piece)):
                a, b = self._symbol(piece[:at]), self._symbol(piece[at:])
                if a is not None and b is not None:
                    keys.append(a << 21 | b)
                    made.append(number)
        order = np.argsort(keys)
        self.merge_keys = np.append(np.array(keys, np.int64)[order], np.int64(1 << 62))
        self.merge_made = np.append(np.array(made, np.int32)[order], np.int32(0))
        costs = np.full(self.first_character, np.inf)
        for piece, number in self.ids.items():
            costs[number] = self.costs[piece]
        self.merge_costs = costs[self.merge_made]
        normal = np.array([len(x) for x in self.surfaces])
        self.source_sizes = np.where(np.isin(np.arange(len(normal)), list(self.raw)), 0, normal)

    def _symbol(self, text: str) -> int | None:
        number = self.ids.get(text)
        return self.first_character + ord(text) if number is None and len(text) == 1 else number

    def learn(self, words: set[str]) -> None:
        """Encode new words together and remember them: in each round every word merges its best pair."""
        new = sorted(w for w in words - self.known.keys() if len(w) <= LONG)
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = sorted(w for w in words if len(w) <= LONG)
        if not new:
            return
        marked = SPACE + SPACE.join(new)
        points = np.frombuffer(marked.encode("utf-32-le"), "<u4").astype(np.int64)
        distinct, back = np.unique(points, return_inverse=True)
        symbols = np.array([self._symbol(chr(c)) for c in distinct.tolist()], np.int64)[back]
        word = np.cumsum(points == ord(SPACE)) - 1

        def look(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            key = left << 21 | right
            at = np.searchsorted(self.merge_keys, key)
            hit = self.merge_keys[at] == key
            return np.where(hit, self.merge_costs[at], np.inf), self.merge_made[at]

        cost = np.full(len(symbols), np.inf)  # of merging a symbol with the next
        made = np.zeros(len(symbols), np.int64)
        inside = np.flatnonzero(word[:-1] == word[1:])
        cost[inside], made[inside] = look(symbols[inside], symbols[inside + 1])
        out_symbols, out_words = [], []
        while len(symbols):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            least = np.minimum.reduceat(cost, starts)
            sizes = np.diff(np.append(starts, len(symbols)))
            going = np.repeat(np.isfinite(least), sizes)
            out_symbols.append(symbols[~going])
            out_words.append(word[~going])
            best = np.flatnonzero(going & (cost == np.repeat(least, sizes)))
            best = best[np.diff(word[best], prepend=-1) != 0]  # the leftmost of each word
            symbols[best] = made[best]
            keep = going
            keep[best + 1] = False
            moved = np.cumsum(keep) - 1
            symbols, word, cost, made = symbols[keep], word[keep], cost[keep], made[keep]
            at = moved[best]
            for left in (at, at[at > 0] - 1):
                left = left[left < len(symbols)]
                last = (left + 1 >= len(symbols)) | (word[np.minimum(left + 1, len(symbols) - 1)] != word[left])
                cost[left[last]] = np.inf
                left = left[~last]
                cost[left], made[left] = look(symbols[left], symbols[left + 1])
        symbols, word = np.concatenate(out_symbols), np.concatenate(out_words)
        order = np.argsort(word, kind="stable")
        symbols, word = symbols[order], word[order]
        odd = np.unique(symbols[symbols >= self.first_character])  # characters spelt in bytes
        spelt = {int(c): chr(int(c) - self.first_character).encode() for c in odd}
        sizes = np.ones(len(symbols), np.int64)
        for c, raw in spelt.items():
            sizes[symbols == c] = len(raw)
        first = np.cumsum(sizes) - sizes
        ids = np.repeat(np.where(symbols < self.first_character, symbols, 0), sizes)
        sources = self.source_sizes[ids]
        for c, raw in spelt.items():
            at = first[symbols == c]
            for k, byte in enumerate(raw):
                ids[at + k] = self.byte_ids[byte]
                sources[at + k] = len(raw) if k == len(raw) - 1 else 0
        ids, sources = ids.astype("<u4").tobytes(), sources.astype("<u4").tobytes()
        borders = (4 * np.append(first[np.flatnonzero(np.diff(word, prepend=-1))], sizes.sum())).tolist()
        for n, w in enumerate(new):
            a, b = borders[n], borders[n + 1]
            self.known[w] = ids[a:b], sources[a:b]

    def encode_stretch(self, stretch: str) -> tuple[bytes, bytes, bytes]:
        """Ids; the normalised bytes each covers, all of a character spelt in bytes by its last; the same in source bytes.

        The last holds where every space mark stands for one source byte.
        """
        ids, sizes, sources = [], [], []
        for symbol in self._merged(stretch):
            known = self.ids.get(symbol)
            raw = symbol.encode()
            if known is not None:
                ids.append(known)
                sizes.append(len(raw))
                sources.append(len(raw) - 2 * symbol.count(SPACE))
            else:
                ids += [self.byte_ids[b] for b in raw]
                sizes += [0] * (len(raw) - 1) + [len(raw)]
                sources += [0] * (len(raw) - 1) + [len(raw) - 2 * (symbol == SPACE)]
        return _packed(ids), _packed(sizes), _packed(sources)

    def encode(self, text: str) -> tuple[bytes, np.ndarray]:
        """Ids as little-endian 32-bit integers, and the source bytes at which each token begins, and the last ends."""
        if self.by_word and SPACE not in text:
            words = text.split(" ")
            if "" not in words:
                # Every mark but the first is one space: a token's source size follows from its piece alone.
                ids, sources = zip(*map(self.known.__getitem__, words), strict=True)
                borders = np.concatenate([[1], np.frombuffer(b"".join(sources), "<u4")]).cumsum() - 2
                borders[0] = 0
                return b"".join(ids), np.maximum(borders, 0)
        normal, origin = self.normalise(text)
        codes = [self.encode_stretch(s) for s in (self.stretches.findall(normal) if self.stretches else [normal] * bool(normal))]
        ends = np.frombuffer(b"".join([c[1] for c in codes]), "<u4").cumsum(dtype=np.int64)
        return b"".join([c[0] for c in codes]), origin[np.concatenate([[0], ends])]

    def prepared(self, texts: Iterator[str]) -> Iterator[str]:
        """The same texts, in stretches whose new words are learned before they are passed on."""
        held, size = [], 0
        for text in itertools.chain(texts, [None]):
            if text is not None:
                held.append(text)
                size += len(text)
            if held and (text is None or size >= TOGETHER):
                if self.by_word:
                    self.learn(set().union(*(t.split(" ") for t in held if SPACE not in t)))
                yield from held
                held, size = [], 0

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 text of the ids: control ids vanish, bytes that form no character become U+FFFD."""
        numbers = np.frombuffer(ids, dtype="<u4")
        at = 0
        while at < len(numbers) and not self.sizes[numbers[at]]:
            at += 1
        numbers = numbers[at:]
        if not len(numbers):
            return b""
        parts = self.surfaces[numbers].tolist()
        if int(numbers[0]) in self.spaced and (self.rules.add_dummy_prefix or self.rules.remove_extra_whitespaces):
            parts[0] = parts[0].lstrip(b" ") if self.rules.remove_extra_whitespaces else parts[0][1:]
        if self.sizes[numbers[:-1]].all():
            joined = b"".join(parts)
            try:
                joined.decode()
                return joined
            except UnicodeDecodeError:
                pass
        # Only bytes that stand side by side may form a character.
        runs = itertools.groupby(zip(numbers.tolist(), parts, strict=True), key=lambda pair: pair[0] in self.raw)
        return b"".join(_repaired(b"".join(p for _, p in run)) if raw else b"".join(p for _, p in run) for raw, run in runs)


def _repaired(raw: bytes) -> bytes:
    """Each byte that belongs to no valid character is replaced by U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        size = _character_size(raw[at])
        try:
            raw[at : at + size].decode()
            out.append(raw[at : at + size])
        except UnicodeDecodeError:
            size = 1
            out.append("�".encode())
        at += size
    return b"".join(out)


def encode_texts(df: DataFrame, model_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 spans: bool = True) -> DataFrame:
    """One row for each row: ``keep``, token ids, byte spans of the tokens, digests of ids and of the decoded text.

    ``spans=False`` leaves the two list columns out and keeps the digests and ``span_bytes``, the
    number of source bytes that the tokens' spans cover.
    """
    spark = df.sparkSession
    with open(model_path, "rb") as file:
        model = spark.sparkContext.broadcast(file.read())
    lists = ", ids array<int>, begins array<int>, ends array<int>" if spans else ""
    own = df.select(*keep, F.col(text).alias("_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1])
    schema = f"{kept}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, span_bytes bigint{lists}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = PieceCoder(model.value)
        first, last = (np.array([i], "<u4").tobytes() for i in (coder.begin, coder.end))
        for batch in batches:
            rows: list[tuple] = []
            for text_ in coder.prepared(texts_of(batch, "_text")):
                ids, borders = coder.encode(text_)
                whole = first + ids + last
                row = (len(whole) // 4, hashlib.sha256(whole).hexdigest(), hashlib.sha256(coder.decode(whole)).hexdigest(),
                       int(borders[-1] - borders[0]))
                if spans:
                    row += (np.frombuffer(ids, "<u4").astype(np.int32), borders[:-1].astype(np.int32), borders[1:].astype(np.int32))
                rows.append(row)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.list_(pa.int32())] * (3 * spans)
            made = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            names = ["n_tokens", "ids_sha256", "decoded_sha256", "span_bytes", "ids", "begins", "ends"][: len(made)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=[*keep, *names])

    return own.mapInArrow(run, schema)
