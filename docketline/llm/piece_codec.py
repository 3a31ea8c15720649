"""SentencePiece BPE encoding by a table of each prefix's last token, and decoding."""

from __future__ import annotations

import codecs
import re
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketline.llm.common import hash_spans, text_chunks

_SPACE = "▁"
_TWO = _SPACE * 2
_NEVER = 1 << 60


def read_vocabulary(model_path: str) -> list[tuple[str, float, str]]:
    """(piece, score, kind) by id; kind: piece, byte, control or unknown. Only the vocabulary
    of the model file is used. It must be a BPE model with byte fallback, no normalisation, a
    space put before the text, and all its spaces kept."""
    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    kinds = [(sp.is_byte, "byte"), (sp.is_control, "control"), (sp.is_unknown, "unknown"), (sp.is_unused, "unused")]
    out = [(sp.id_to_piece(i), sp.get_score(i), next((k for f, k in kinds if f(i)), "piece"))
           for i in range(sp.get_piece_size())]
    probe = "a  ﬁ b "
    if sp.normalize(probe) != _SPACE + probe.replace(" ", _SPACE) or not any(k == "byte" for _, _, k in out):
        raise ValueError("unsupported model: normalisation, or no byte pieces")
    if any(k == "unused" for _, _, k in out):
        raise ValueError("unsupported model: unused pieces")
    return out


class PieceCodec(dict):
    """Encodes as greedy BPE does: always the best-scored merge of neighbours, leftmost first.

    Each prefix of a text has one encoding, hence one last token. It is the token
    that ends there and is compatible with the last token of the prefix before it:
    two tokens are compatible when merging their joint text gives just these two.
    A sequence whose neighbours are all compatible is the encoding of its text, since a merge
    over a border depends on the two tokens at the border only.

    Pieces that share one score (the lowest, for runs of spaces here) have no rank among
    them; they are merged last, leftmost first, by ``_space_runs``.
    """

    def __init__(self, vocabulary: list[tuple[str, float, str]], cache_size: int = 600_000):
        super().__init__()   # what it holds as a dict: the ids of units seen before
        self.words: dict[int, tuple[int, ...]] = {}
        self.cache_size = cache_size
        kinds = [k for _, _, k in vocabulary]
        self.byte_id = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(vocabulary) if k == "byte"}
        self.eos = next(i for i, (p, _, k) in enumerate(vocabulary) if k == "control" and p == "</s>")
        score: dict[float, int] = {}
        for p, s, k in vocabulary:
            if k == "piece" and len(p) > 1:
                score[s] = score.get(s, 0) + 1
        pieces = {p: i for i, (p, _, k) in enumerate(vocabulary) if k == "piece"}
        tied = {p for p, s, k in vocabulary if k == "piece" and len(p) > 1 and score[s] > 1}
        lowest = min((s for p, s, k in vocabulary if k == "piece" and len(p) > 1), default=0)
        if any(vocabulary[pieces[p]][1] > lowest or set(p) != {_SPACE} for p in tied):
            raise ValueError("unsupported model: equal scores other than those of space runs")
        if any(re.search(f"[^{_SPACE}]{_SPACE}", p) for p in pieces):
            raise ValueError("unsupported model: a piece goes over a word border")
        self.runs = {len(p): pieces[p] for p in tied}
        if _SPACE in pieces:
            self.runs[1] = pieces[_SPACE]
        # symbols: the pieces, and characters that occur in pieces without being one
        self.symbol = {p: i for p, i in pieces.items() if p not in tied}
        self.n_pieces = len(vocabulary)
        for ch in sorted({c for p in self.symbol for c in p} - self.symbol.keys()):
            self.symbol[ch] = self.n_pieces + len([x for x in self.symbol.values() if x >= self.n_pieces])
        self.text = {i: p for p, i in self.symbol.items()}
        ranked = sorted((p for p in self.symbol if len(p) > 1), key=lambda p: -vocabulary[pieces[p]][1])
        self.pair: dict[tuple[int, int], int] = {}
        made = {}
        for rank, p in enumerate(ranked):
            made[rank] = self.symbol[p]
            for cut in range(1, len(p)):
                a, b = self.symbol.get(p[:cut]), self.symbol.get(p[cut:])
                if a is not None and b is not None:
                    self.pair[a, b] = rank
        self.made = made
        # how each token comes about: ranks of its merges in order, with its first and last symbol after each
        self.left_edge: dict[int, list[tuple[int, int]]] = {}
        self.right_edge: dict[int, list[tuple[int, int]]] = {}
        words = ahocorasick.Automaton()
        for p, i in self.symbol.items():
            steps = self._merges([self.symbol[c] for c in p])
            if steps is not None:
                self.left_edge[i] = [(r, first) for r, first, _ in steps]
                self.right_edge[i] = [(r, last) for r, _, last in steps]
                words.add_word(p, (i, len(p)))
        words.make_automaton()
        self.automaton = words
        self.known = {c for p in self.symbol for c in p}
        self.units = self._unit_pattern(pieces)
        self.ok: dict[int, bool] = {}
        self.raw = [bytes([int(p[3:5], 16)]) if k == "byte" else b"" if k == "control" else
                    p.replace(_SPACE, " ").encode() if k == "piece" else b" \xe2\x81\x87 " for p, _, k in vocabulary]
        self.kinds = kinds

    @staticmethod
    def _unit_pattern(pieces) -> re.Pattern:
        """Spaces and a run of characters that pieces can join: no merge goes over the end of such a unit.

        Characters that stand side by side in some piece are of one class; other characters stand alone."""
        root: dict[str, str] = {}

        def find(c: str) -> str:
            while root.setdefault(c, c) != c:
                c = root[c]
            return c

        for p in pieces:
            for a, b in zip(p, p[1:]):
                if a != _SPACE:
                    root[find(a)] = find(b)
        classes: dict[str, str] = {}
        for c in sorted(root):
            classes[find(c)] = classes.get(find(c), "") + c
        runs = [f"[{re.escape(x)}]+" for x in classes.values()]
        return re.compile(f"{_SPACE}*(?:{'|'.join([*runs, f'[^{_SPACE}]'])})|{_SPACE}+", re.DOTALL)

    def _merges(self, syms: list[int]) -> list[tuple[int, int, int]] | None:
        """The merges that make one token of ``syms``, or None where they do not end in one."""
        steps = []
        while len(syms) > 1:
            rank, at = min((self.pair.get(ab, _NEVER), k) for k, ab in enumerate(zip(syms, syms[1:])))
            if rank == _NEVER:
                return None
            syms = [*syms[:at], self.made[rank], *syms[at + 2:]]
            steps.append((rank, syms[0], syms[-1]))
        return steps

    def compatible(self, t1: int, t2: int) -> bool:
        """Whether the merges inside both tokens all come before any merge over their border."""
        one, two = self.right_edge[t1], self.left_edge[t2]
        a, b = self.symbol[self.text[t1][-1]], self.symbol[self.text[t2][0]]
        i = j = 0
        while True:
            over = self.pair.get((a, b), _NEVER)
            r1 = one[i][0] if i < len(one) else _NEVER
            r2 = two[j][0] if j < len(two) else _NEVER
            if r1 <= r2:  # on equal ranks the leftmost goes first
                if over < r1:
                    return False
                if r1 == _NEVER:
                    return True
                a, i = one[i][1], i + 1
            else:
                if over <= r2:
                    return False
                b, j = two[j][1], j + 1

    def _known_run(self, s: str) -> list[int]:
        """Symbols of a text of known characters, from the table of last tokens."""
        last: list[int] = [-1] * (len(s) + 1)
        size = [0] * (len(s) + 1)
        ok = self.ok
        for end, (t, n) in self.automaton.iter(s):
            end += 1
            if last[end] >= 0:
                continue
            start = end - n
            if start:
                p = last[start]
                if p < 0:
                    continue
                fits = ok.get(p << 20 | t)
                if fits is None:
                    if len(ok) > 2_000_000:
                        ok.clear()
                    fits = ok[p << 20 | t] = self.compatible(p, t)
                if not fits:
                    continue
            last[end], size[end] = t, n
        out, at = [], len(s)
        while at:
            out.append(last[at])
            at -= size[at]
        return out[::-1]

    def _space_runs(self, syms: list[int]) -> list[int]:
        """Merges neighbouring space symbols by the pieces without rank, leftmost first."""
        one = self.runs.get(1)
        if one is None or len(self.runs) < 2:
            return syms
        out: list[int] = []
        lens: list[int] = []  # of the run symbols at the end of out, 0 for others
        for t in syms:
            out.append(t)
            lens.append(1 if t == one else 0)
            while len(out) > 1 and lens[-1] and lens[-2] and lens[-1] + lens[-2] in self.runs:
                n = lens.pop() + lens.pop()
                out[-2:] = [self.runs[n]]
                lens.append(n)
        return out

    def __missing__(self, unit: str) -> tuple[int, ...]:
        """The ids of a unit: spaces, then known characters or a single unknown one."""
        if unit[-1] in self.known:
            syms = self._known_run(unit)
        else:
            syms = (self._known_run(unit[:-1]) if len(unit) > 1 else []) + [self.byte_id[b] for b in unit[-1].encode()]
        if unit.startswith(_TWO):
            syms = self._space_runs(syms)
        if max(syms) >= self.n_pieces:
            syms = list(chain.from_iterable([t] if t < self.n_pieces else [self.byte_id[b] for b in self.text[t].encode()]
                                            for t in syms))
        out = self[unit] = tuple(syms)
        return out

    def forget(self) -> None:
        """Drop the remembered words."""
        self.clear()
        self.words.clear()

    def word(self, key: int, raw: bytes) -> tuple[int, ...]:
        """The ids of spaces and what follows them up to the next space, by the word's hash."""
        out = self.words.get(key)
        if out is None:
            if len(self) + len(self.words) > self.cache_size:
                self.forget()
            units = self.units.findall(raw.decode().replace(" ", _SPACE))
            out = self.words[key] = tuple(chain.from_iterable(map(self.__getitem__, units)))
        return out

    def encode_texts(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, cuts) of texts that lie in a row in ``data``; each text's ids end with the end id.

        No piece goes over the border before a space, so words are coded apart: each distinct one of
        the chunk once, and once for all that a worker remembers."""
        mark = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81))
        if len(mark):                                    # the space symbol itself stands for a space
            data = data.copy()
            data[mark] = 32
            data, offs = np.delete(data, np.r_[mark + 1, mark + 2]), offs - 2 * np.searchsorted(mark, offs)
        some = offs[1:] > offs[:-1]
        buf = np.insert(data, offs[:-1][some], 32)       # the space put before a text
        offs = offs + np.r_[0, np.cumsum(some)]
        space = buf[:offs[-1]] == 32
        start = space.copy()
        start[1:] &= ~space[:-1]
        start[offs[:-1][some]] = True
        s = np.flatnonzero(start)
        e = np.r_[s[1:], offs[-1:]][:len(s)]
        keys, first, inv = np.unique(hash_spans(buf, s, e), return_index=True, return_inverse=True)
        words = [self.word(k, buf[a:b].tobytes()) for k, a, b in zip(keys.tolist(), s[first].tolist(), e[first].tolist())]
        count = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.fromiter(chain.from_iterable(words), np.int32, int(count.sum()))
        begin, n = (np.cumsum(count) - count)[inv], count[inv]
        ids = flat[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        per_text = np.bincount(np.searchsorted(offs, s, "right") - 1, weights=n, minlength=len(some)).astype(np.int64)
        ends = np.cumsum(per_text)
        return np.insert(ids, ends, self.eos), np.r_[0, ends + np.arange(1, len(ends) + 1)]

    def encode(self, text: str) -> np.ndarray:
        raw = text.encode()
        return self.encode_texts(np.frombuffer(raw + bytes(8), np.uint8), np.array([0, len(raw)]))[0]

    def decode(self, ids) -> str:
        """The text of ids: byte pieces as UTF-8 (a byte that is none becomes U+FFFD), without the space put before the text."""
        raw = b"".join(map(self.raw.__getitem__, ids))
        first = next((i for i in ids if self.kinds[i] != "control"), None)
        if first is not None and self.kinds[first] == "piece":
            raw = raw.removeprefix(b" ")
        return raw.decode("utf-8", "one_each")


codecs.register_error("one_each", lambda e: ("�", e.start + 1))
_CODECS: dict[int, PieceCodec] = {}


def _codec(vocabulary) -> PieceCodec:
    """One codec per worker process and vocabulary."""
    key = hash(tuple(vocabulary[-1])) ^ len(vocabulary)
    if key not in _CODECS:
        _CODECS[key] = PieceCodec(vocabulary)
    return _CODECS[key]


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded), one row per input row: the ids with the end id, and their text.

    A narrow pass: no shuffle, no state between rows but a bounded memory of words.
    Null and empty texts have the end id only. The model file is read on the driver; its vocabulary
    (a fixed size) is broadcast.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(model_path))

    def run(batches):
        codec = _codec(vocabulary.value)
        for c in text_chunks(batches):
            ids, cuts = codec.encode_texts(c.data, c.offs)
            decoded = [codec.decode(ids[a:b].tolist()) for a, b in zip(cuts, cuts[1:])]
            yield pa.record_batch({"doc_id": c.rows.column("doc_id"), "decoded": pa.array(decoded, pa.string()),
                                   "ids": pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids))})
        codec.forget()   # a worker goes on with other stages; only the tables of the vocabulary stay

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
                       ).mapInArrow(run, "doc_id long, decoded string, ids array<int>")
