"""SentencePiece encoding and decoding by streaming Viterbi.

The search goes through the lattice of the pieces that can start at each place of a text. Only the last
`longest piece` states can still be extended, so it keeps a window of that many. Once the backpointer
paths of all open states pass through one boundary, the pieces up to it are final and are committed.

With a unigram model, a state keeps the best sum of scores. With a merge (BPE) model, a step is allowed
only where the two pieces stay apart when their joined text is merged on its own; each prefix then has
exactly one path, which is the segmentation that merging gives. The ids are those of the model either way.

Pieces do not cross the start of a word, so all paths meet there: what lies between is committed. The distinct words of some
hundred texts are searched together, boundary by boundary, and remembered as long as a task has room.
"""

from __future__ import annotations

import functools
import hashlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.context_coding import Lookup
from marketlens.llm.words import tidy

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
PIECES = 1 << 24
CACHE, PAIRS = 300_000, 200_000  # words, stretches and pairs that a task remembers; only time depends on them
WORD = 40  # words of fewer characters are searched together
_CODE, _ODD, _BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x632BE59BD9B4E019), np.uint64(0xD6E8FEB86659FD93)


def _hash(text: str) -> int:
    """64-bit hash of a piece, as it is built up character by character."""
    h = 0
    for c in text:
        h = (h * int(_BASE) + ord(c) * int(_CODE) + int(_ODD)) % (1 << 64)
    return h


class Coder:
    """Pieces, scores and byte pieces of a model file."""

    def __init__(self, model: str | bytes):
        sp = sentencepiece.SentencePieceProcessor(
            **({"model_proto": model} if isinstance(model, bytes) else {"model_file": model}))
        size = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(size)]
        self.merges = self._model_type(sp.serialized_model_proto()) == 2
        self.unknown = sp.unk_id()
        self.bytes = {int(t[3:5], 16): i for i, t in enumerate(self.text) if sp.is_byte(i)}
        of_byte = {i: b for b, i in self.bytes.items()}
        self.raw = [bytes([of_byte[i]]) if i in of_byte else b"" if sp.is_control(i) else t.encode() for i, t in enumerate(self.text)]
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.score = {self.text[i]: (float(sp.get_score(i)), i) for i in plain}
        self.longest = max(map(len, self.score))
        self.penalty = min(s for s, _ in self.score.values()) - UNKNOWN_PENALTY
        #: Ids of pieces; -1 for what only ends one.
        self.ends: dict[str, int] = {t[n:]: -1 for t in self.score for n in range(1, len(t))}
        self.ends.update({t: i for t, (_, i) in self.score.items()})
        self.value = [sp.get_score(i) for i in range(size)]
        self.beside = {t[k:k + 2] for t in self.score for k in range(len(t) - 1)}
        self.crossing = any(SPACE in t[1:] and t.strip(SPACE) for t in self.score)
        self.by_hash = Lookup(np.array([_hash(t) for t in self.score], np.uint64).view(np.int64), np.array([i for _, i in self.score.values()], float))
        self.pairs: dict[int, bool] = {}
        self.spines: dict[int, tuple[bool, list[tuple[float, str, str]]]] = {}
        self.widest = 0
        self.cache: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    @staticmethod
    def _model_type(proto: bytes) -> int:
        from sentencepiece import sentencepiece_model_pb2
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(proto)
        return spec.trainer_spec.model_type

    def steps(self, text: str) -> list[tuple[float, str, str]]:
        """Merges neighbours, the best score first and then the leftmost, until none form a piece: score, first and last part after each."""
        parts, done = list(text), []
        while len(parts) > 1:
            best, at = -float("inf"), -1
            for k in range(len(parts) - 1):
                got = self.score.get(parts[k] + parts[k + 1])
                if got is not None and got[0] > best:
                    best, at = got[0], k
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            done.append((best, parts[0], parts[-1]))
        return done

    def _spine(self, piece: int) -> tuple[bool, list[tuple[float, str, str]]]:
        """Whether a piece's own text merges to it, and the merges that lead there."""
        got = self.spines.get(piece)
        if got is None:
            text = self.text[piece]
            done = self.steps(text)
            got = self.spines[piece] = (len(text) == 1 or bool(done) and done[-1][1] == text, done)
        return got

    def _apart(self, left: int, right: int) -> bool:
        """Whether two pieces stay as they are when their joined text is merged; left below 0 is the start or an unknown character.

        The parts at the seam are followed through the merges of both sides in the order of their scores; the pieces stay
        apart unless the parts merge across the seam first.
        """
        answer, ahead = self._spine(right)
        if left >= 0 and answer:
            answer, behind = self._spine(left)
            i, j, u, v = 0, 0, self.text[left][-1], self.text[right][0]
            while answer:
                across = self.score.get(u + v)
                a = behind[i][0] if i < len(behind) else None
                b = ahead[j][0] if j < len(ahead) else None
                if across is not None and (a is None or across[0] > a) and (b is None or across[0] >= b):
                    answer = False
                elif a is not None and (b is None or a >= b):
                    u, i = behind[i][2], i + 1
                elif b is not None:
                    v, j = ahead[j][1], j + 1
                else:
                    break
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[left * PIECES + right] = answer
        return answer

    def viterbi(self, text: str) -> list[int]:
        """Ids of the segmentation, committed from a bounded window; -2 - c stands for unknown code point c.

        Per boundary from `base` on, the window holds where its best piece starts, the piece and the score. The pieces that
        end at a boundary are looked up from the shortest one; with merges the first allowed one is the only one.
        """
        ends_get, pair_get, merges, longest, n = self.ends.get, self.pairs.get, self.merges, self.longest, len(text)
        came, piece, score = [0], [-1], [0.0]
        out: list[int] = []
        base = 0
        for k in range(1, n + 1):
            start, best, total = -1, -1, 0.0
            low = k - longest if k - longest > base else base
            for i in range(k - 1, low - 1, -1):
                got = ends_get(text[i:k])
                if got is None:
                    break
                if got >= 0:
                    if merges:
                        left = piece[i - base]
                        ok = pair_get(left * PIECES + got)
                        if ok or ok is None and self._apart(left, got):
                            start, best = i, got
                            break
                    else:
                        sum_ = score[i - base] + self.value[got]
                        if start < 0 or sum_ >= total:
                            start, best, total = i, got, sum_
            if (start < 0 or not merges) and ends_get(text[k - 1], -1) < 0:
                sum_ = 0.0 if merges else score[k - 1 - base] + self.penalty
                if start < 0 or sum_ > total:
                    start, best, total = k - 1, -2 - ord(text[k - 1]), sum_
            came.append(start)
            piece.append(best)
            if not merges:
                score.append(total)
            if k == n or k - base >= 2 * longest:
                meet = k if k == n else self._meeting(came, base, range(max(base, k - longest + 1), k + 1))
                path, at = [], meet
                while at > base:
                    path.append(piece[at - base])
                    at = came[at - base]
                out.extend(reversed(path))
                self.widest = max(self.widest, len(came))
                del came[:meet - base], piece[:meet - base], score[:meet - base]
                base = meet
        return out

    @staticmethod
    def _meeting(came: list[int], base: int, ends: Iterable[int]) -> int:
        """Last boundary that the paths of all open states pass."""
        open_ends = set(ends)
        while len(open_ends) > 1:
            top = max(open_ends)
            open_ends.remove(top)
            open_ends.add(max(base, came[top - base]))
        return open_ends.pop()

    def _pieces(self, stretch: str) -> bytes:
        """Ids of a stretch, cut where no piece has the two characters side by side, so that all paths meet."""
        ids = self.cache.get(stretch)
        if ids is None:
            cuts = [0, *(k for k in range(1, len(stretch)) if stretch[k - 1:k + 1] not in self.beside), len(stretch)]
            if len(cuts) > 2:
                return b"".join(self._pieces(stretch[a:b]) for a, b in zip(cuts, cuts[1:]))
            ids = array("i", self._spell(self.viterbi(stretch))).tobytes()
            if len(stretch) <= 64 and stretch[0] != SPACE:
                if len(self.cache) >= CACHE:
                    self.cache.clear()
                self.cache[stretch] = ids
        return ids

    def _spell(self, ids: list[int]) -> Iterator[int]:
        for i in ids:
            if i >= 0:
                yield i
            elif self.bytes:
                yield from (self.bytes[b] for b in chr(-2 - i).encode())
            else:
                yield self.unknown

    def _word(self, part: str) -> bytes:
        """Ids of a word with the space before it, remembered by the word."""
        ids = self._pieces(SPACE + part)
        if len(part) < 64:
            if len(self.words) >= CACHE:
                self.words.clear()
            self.words[part] = ids
        return ids

    def packed(self, text: str | None) -> bytes:
        """Ids of a text as 32-bit integers; null and empty have none."""
        if not text:
            return b""
        if self.crossing:
            return self._pieces((SPACE + text).replace(" ", SPACE))
        text = text.replace(SPACE, " ")
        parts = text.split(" ")
        if "" not in parts:
            found = list(map(self.words.get, parts))
            if None in found:
                for k, ids in enumerate(found):
                    if ids is None:
                        found[k] = self.words.get(parts[k]) or self._word(parts[k])
            return b"".join(found)
        out: list[bytes] = []
        pending, last, get = "", len(parts) - 1, self.words.get
        for k, part in enumerate(parts):  # a run of spaces leaves empty parts, joined to the next one
            if part and not pending:
                out.append(get(part) or self._word(part))
            else:
                pending += SPACE
                if part or k == last:
                    out.append(self._pieces(pending + part))
                    pending = ""
        return b"".join(out)

    def learn(self, texts: Iterable[str | None]) -> None:
        """Searches the words of some texts that are not remembered yet, all at once."""
        if not self.merges or self.crossing:
            return
        new = {w for t in texts if t for w in t.replace(SPACE, " ").split(" ")}
        missing = [w for w in new if w not in self.words]
        if len(self.words) + len(missing) > CACHE:
            self.words.clear()
            missing = list(new)
        missing = sorted((w for w in missing if 0 < len(w) < WORD), key=len)
        start = 0
        while start < len(missing):
            most = len(missing[start]) * 5 // 4 + 2
            end = start + 1
            while end < len(missing) and len(missing[end]) <= most and end - start < 4096:
                end += 1
            for word, ids in zip(missing[start:end], self._search(missing[start:end])):
                if ids is not None:
                    self.words[word] = ids
            start = end

    def _allowed(self, keys: np.ndarray) -> np.ndarray:
        """Which pairs (left * PIECES + right) stay apart."""
        distinct, back = np.unique(keys, return_inverse=True)
        known = [self.pairs.get(x) for x in distinct.tolist()]
        for i, x in enumerate(known):
            if x is None:
                left, right = divmod(int(distinct[i]), PIECES)
                known[i] = self._apart(left, right)
        return np.array(known, bool)[back]

    def _search(self, words: list[str]) -> list[bytes | None]:
        """Ids of viterbi for many words with a space before each, boundary by boundary; None where it finds no way.

        A word is at most a few windows long, so nothing is committed before its end, where all its paths meet.
        """
        n, size = len(words), np.array([len(w) + 1 for w in words])
        width = int(size.max())
        flat = np.frombuffer("".join(SPACE + w for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        row = np.repeat(np.arange(n), size)
        column = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        codes, points = np.zeros((n, width), np.uint64), np.zeros((n, width), np.int64)
        codes[row, column], points[row, column] = flat * _CODE + _ODD, flat.astype(np.int64)
        ids = np.full((min(self.longest, width) + 1, n, width), -1, np.int64)
        running = np.zeros((n, width), np.uint64)
        for length in range(1, len(ids)):
            at = width - length + 1
            running = running[:, :at] * _BASE + codes[:, length - 1:]
            value, hit = self.by_hash.find(np.ascontiguousarray(running).ravel().view(np.int64))
            ids[length, :, :at] = np.where(hit, value, -1).reshape(n, at)
        bad = np.zeros(n, bool)
        piece, step = np.full((n, width + 1), -1, np.int64), np.zeros((n, width + 1), np.int64)
        for k in range(1, width + 1):
            todo = np.flatnonzero((size >= k) & ~bad)
            for length in range(1, min(k, len(ids) - 1) + 1):
                candidate = ids[length, todo, k - length]
                at = np.flatnonzero(candidate >= 0)
                if len(at):
                    rows = todo[at]
                    ok = self._allowed(piece[rows, k - length] * PIECES + candidate[at])
                    piece[rows[ok], k], step[rows[ok], k] = candidate[at][ok], length
                    todo = np.delete(todo, at[ok])
                    if not len(todo):
                        break
            alone = ids[1, todo, k - 1] < 0
            piece[todo[alone], k], step[todo[alone], k] = -2 - points[todo[alone], k - 1], 1
            bad[todo[~alone]] = True
        position, columns, every = np.where(bad, 0, size), [], np.arange(n)
        while position.any():
            columns.append(np.where(position > 0, piece[every, position], -1))  # no piece and no character is -1
            position = position - step[every, position]
        path = np.stack(columns[::-1], 1) if columns else np.zeros((n, 0), np.int64)
        ends = np.concatenate([[0], np.cumsum((path != -1).sum(1))]) * 4
        raw = path[path != -1].astype("<i4").tobytes()
        out = [None if b else raw[x:y] for b, x, y in zip(bad.tolist(), ends[:-1].tolist(), ends[1:].tolist())]
        for i in np.flatnonzero((path < -1).any(1) & ~bad):
            out[i] = array("i", self._spell(array("i", out[i]))).tobytes()
        return out

    def encode(self, text: str | None) -> list[int]:
        return array("i", self.packed(text)).tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; runs of byte pieces are read as UTF-8."""
        out = b"".join(map(self.raw.__getitem__, ids))
        text = out.decode(errors="replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


@functools.cache
def coder(model: str) -> Coder:
    return Coder(model)


def encode(docs: DataFrame, model: str = MODEL, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, ids and whether they decode to the text, for each row of docs.

    Null and empty texts have no ids. A text with U+2581 decodes to spaces in its place, as in the
    format itself; `round_trip` is false there. Repeated rows give repeated results; other columns are
    not looked at.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                if at % 512 == 0:
                    c.learn(batch.column(1).slice(at, 512).to_pylist())
                texts = batch.column(1).slice(at, 64).to_pylist()
                blobs = [c.packed(t) for t in texts]
                ok = [c.decode(array("i", i)) == (t or "") for i, t in zip(blobs, texts)]
                cut = np.concatenate([[0], np.cumsum([len(i) // 4 for i in blobs])]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(cut), pa.array(np.frombuffer(b"".join(blobs), "<i4")))
                digests = [hashlib.sha256(i).hexdigest() for i in blobs]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, 64), column, pa.array(ok, pa.bool_()), pa.array(digests, pa.string())],
                    ["doc_id", "ids", "round_trip", "ids_sha256"])

    return docs.select(F.col(id_column).cast("long"), F.col(text_column)).mapInArrow(
        tidy(run), "doc_id long, ids array<int>, round_trip boolean, ids_sha256 string")


def decode(encoded: DataFrame, model: str = MODEL, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """doc_id and the text of the ids of each row; null ids give an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                texts = [c.decode(i or []) for i in batch.column(1).slice(at, 64).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 64), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col(id_column).cast("long"), F.col(ids_column)).mapInArrow(run, "doc_id long, text string")
