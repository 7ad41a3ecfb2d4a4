"""Encoding and decoding with a SentencePiece vocabulary, by the N best segmentations.

A text is a lattice of pieces; a segmentation is a path, and its score the sum of the scores of its pieces. Viterbi
scores from the front are exact heuristics for an A-star search from the back, which therefore completes
the N best paths and touches little else. The lattice falls apart wherever two neighbouring characters never
stand inside one piece, so it is worked on stretch by stretch. The words of a run of texts are numbered by Arrow; the
best path of each distinct one, and what the next best loses, are remembered in arrays. The search runs in the few words
of a text that lose least, and the N best of the text are merged from theirs.
"""

from __future__ import annotations

import heapq
import re
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm.shingles import runs

SPACE = "▁"
STRETCH = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
#: Stretches that a task remembers, and the longest one worth it.
KEPT, LONGEST_KEPT = 1 << 19, 48
#: Bytes of the distinct words that a task remembers, and of a run of texts.
REMEMBERED, RUN = 1 << 24, 1 << 21
#: Characters of words of one length that go through one lattice.
AT_ONCE = 1 << 15
#: Words that the library is given as one text, and at once.
JOINED, GIVEN = 64, 1 << 14
#: The steps of the vocabulary are found by a product of their keys, in so many slots.
PRODUCT, SLOTS = np.uint64(0x9E3779B97F4A7C15), 18


def words_in(text: str) -> list[str]:
    """The words of a text, each with the blanks before it."""
    if "  " in text or SPACE in text or text.startswith(" "):
        return STRETCH.findall(SPACE + text.replace(" ", SPACE))
    return [SPACE + w for w in text.split(" ")] if text else []


def blanked(text: str) -> bytes:
    """A text with the blank before its first word, the blank sign as a blank, in UTF-8."""
    return (" " + text.replace(SPACE, " ")).encode("utf-8", "surrogatepass") if text else b""


def ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """So many numbers from each first one on, in a row."""
    upto = np.cumsum(count)
    return np.repeat(first - upto + count, count) + np.arange(upto[-1] if len(upto) else 0)


def buffers(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin among their bytes, and the last ends; and these bytes."""
    _, places, data = words.buffers()
    places = np.frombuffer(places, np.int64)[words.offset : words.offset + len(words) + 1]
    return places - places[0], np.frombuffer(data or b"", np.uint8)[places[0] : places[-1]]


class Words:
    """Numbers for the distinct words of texts, which they keep until the words take more than ``REMEMBERED`` bytes."""

    def __init__(self) -> None:
        self.known = pa.array([], pa.large_binary())

    def number(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
        """The number of every word of blanked texts, in order; where each text begins among them, and the last ends;
        how many words are known from before."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum([0, *map(len, texts)])
        # A word begins at its first blank, each text at a word.
        begins = data == 32
        begins[1:] &= data[:-1] != 32
        begins[ends[:-1][np.diff(ends) > 0]] = True
        places = np.flatnonzero(begins)
        words = pa.Array.from_buffers(pa.large_binary(), len(places), [
            None, pa.py_buffer(np.append(places, len(data)).astype(np.int64)), pa.py_buffer(data)])
        coded = pa.concat_arrays([self.known, words]).dictionary_encode()
        if len(self.known) and coded.dictionary.nbytes > REMEMBERED:
            self.known, coded = self.known[:0], words.dictionary_encode()
        before, self.known = len(self.known), coded.dictionary
        return coded.indices.to_numpy()[before:], np.searchsorted(places, ends), before


Segmentation = tuple[float, tuple[int, ...]]
#: Score, ids, and what the next best segmentation loses.
Best = tuple[float, bytes, float]


class Vocabulary:
    """Pieces with scores, the model's own unless others are given; characters without a piece are their bytes,
    as one edge of the lattice."""

    def __init__(self, path: str, scores: list[float] | None = None) -> None:
        import sentencepiece

        model = self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(n)]
        self.byte = {int(self.text[i][1:-1], 16): i for i in range(n) if model.is_byte(i)}
        self.value = {i: b for b, i in self.byte.items()}
        self.score = scores or [model.get_score(i) for i in range(n)]
        self.unknown = model.unk_id()
        special = {i for i in range(n) if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.piece = {self.text[i]: i for i in range(n) if i not in special}
        self.longest = max(map(len, self.piece), default=1)
        #: What pieces begin with: the piece itself, or -1 if it is only the beginning of others.
        self.begins = {p[:k]: -1 for p in self.piece for k in range(1, len(p))} | self.piece
        self.inside = {p[k : k + 2] for p in self.piece for k in range(len(p) - 1)}
        # A step from a beginning to a longer one: its number and the next character, as one sorted key.
        node = {text: number for number, text in enumerate(self.begins, 1)} | {"": 0}
        steps = sorted((node[t[:-1]] << 21 | ord(t[-1]), node[t], found) for t, found in self.begins.items())
        self.step, self.to, self.ends = (np.array(x, np.int64) for x in zip(*steps))
        self.edge_score = np.array(self.score)
        # The first step has a table: where in ``step`` a character is, or -1.
        begins = np.flatnonzero(self.step >> 21 == 0)
        self.first_step = np.full(sys.maxunicode + 1, -1, np.int32)
        self.first_step[self.step[begins]] = begins
        # Other steps: one of each slot, and whether it has more. Behind the last step stands one that no key is.
        slot = self._slot(self.step)
        self.in_slot = np.full(1 << SLOTS, len(self.step), np.int32)
        self.in_slot[slot] = np.arange(len(self.step))
        self.shared = np.bincount(slot, minlength=1 << SLOTS) > 1
        self.step = np.append(self.step, 1 << 62)

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * PRODUCT) >> np.uint64(64 - SLOTS)).view(np.int64)

    def _steps(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``step`` keys are, and whether they are there."""
        slot = self._slot(keys)
        found = self.in_slot[slot]
        alive = self.step[found] == keys
        again = np.flatnonzero(self.shared[slot] & ~alive)
        if len(again):
            found[again] = np.searchsorted(self.step, keys[again])
            alive[again] = self.step[found[again]] == keys[again]
        return found, alive

    def fallback(self, char: str) -> tuple[int, ...]:
        found = tuple(self.byte.get(b, -1) for b in char.encode("utf-8", "surrogatepass"))
        return found if -1 not in found else (self.unknown,)

    def library_counts(self, words: pa.Array, times: np.ndarray) -> np.ndarray:
        """How often each piece stands in the library's own segmentation of blanked words, each so many times; no piece
        reaches over such a begin."""
        n = np.zeros(len(self.text), np.int64)
        places, data = buffers(words)
        # Blanks alone would be read with the next word.
        lone = data[places[1:] - 1] == 32
        for k in np.flatnonzero(lone).tolist():
            # The library has nothing for an empty text.
            ids = self.model.encode(" " * (int(places[k + 1] - places[k]) - 1)) or [self.piece.get(SPACE, self.unknown)]
            n += int(times[k]) * np.bincount(ids, minlength=len(n))
        # Words that occur equally often are joined. Without a piece for the blank, unknown characters would meet.
        joined = JOINED if SPACE in self.piece else 1
        order = np.argsort(times, kind="stable")
        order = order[~lone[order]]
        times = times[order]
        places, data = buffers(words.take(pa.array(order)))
        heads = np.flatnonzero(np.diff(times, prepend=-1, append=-1)).tolist()
        for a, b in ((k, min(k + GIVEN, end)) for head, end in zip(heads[:-1], heads[1:]) for k in range(head, end, GIVEN)):
            cuts = [*places[a:b:joined].tolist(), int(places[b])]
            texts = [data[i + 1 : j].tobytes().decode("utf-8", "surrogatepass") for i, j in zip(cuts[:-1], cuts[1:])]
            ids = self.model.encode(texts, num_threads=1)
            n += int(times[a]) * np.bincount(np.concatenate([np.array(i, np.int64) for i in ids]), minlength=len(n))
        return n

    def lattice(self, text: str) -> tuple[list[list[tuple[int, float, tuple[int, ...]]]], list[float]]:
        """For each end the pieces that end there, as begin, score, ids; and the best score from the front."""
        size, longest, begins, score = len(text), self.longest, self.begins.get, self.score
        into: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in range(size + 1)]
        front = [0.0] + [float("-inf")] * size
        for i in range(size):
            here, alone = front[i], False
            for j in range(i + 1, min(size, i + longest) + 1):
                found = begins(text[i:j])
                if found is None:
                    break
                if found >= 0:
                    alone = alone or j == i + 1
                    s = score[found]
                    into[j].append((i, s, (found,)))
                    if here + s > front[j]:
                        front[j] = here + s
            if not alone:
                ids = self.fallback(text[i])
                s = sum(score[k] for k in ids)
                into[i + 1].append((i, s, ids))
                front[i + 1] = max(front[i + 1], here + s)
        return into, front

    def best(self, text: str) -> Best:
        """The best segmentation of a stretch, and by how much the next best is worse."""
        into, front = self.lattice(text)
        ids: list[tuple[int, ...]] = []
        taken, j = set(), len(text)
        while j:
            for edge in into[j]:
                # Of equal scores the longest last piece, as in the search below.
                if front[edge[0]] + edge[1] == front[j]:
                    break
            taken.add((edge[0], j))
            ids.append(edge[2])
            j = edge[0]
        back = [float("-inf")] * len(text) + [0.0]
        second = float("-inf")
        for j in range(len(text), 0, -1):
            rest = back[j]
            for i, s, _ in into[j]:
                total = s + rest
                if total > back[i]:
                    back[i] = total
                if (i, j) not in taken and front[i] + total > second:
                    second = front[i] + total
        return front[-1], np.array([k for part in reversed(ids) for k in part], "<u4").tobytes(), front[-1] - second

    def best_of_words(self, words: list[str]) -> list[Best]:
        """What ``best`` gives for each of many words, by ``best_paths``."""
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        score, loss, first, count, ids = self.best_paths(chars, np.fromiter(map(len, words), np.int64, len(words)))
        return [(s, ids[a : a + n].tobytes(), x) for s, x, a, n in zip(*(x.tolist() for x in (score, loss, first, count)))]

    def best_paths(self, chars: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """The best segmentations of words of so many characters each: score, what the next best loses, and where the
        ids of each begin in the last array, and how many they are. Words of one length share a lattice."""
        score, loss = np.zeros(len(sizes)), np.full(len(sizes), np.inf)
        first, count = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        begin, order = np.cumsum(sizes) - sizes, np.argsort(sizes, kind="stable")
        ids, made = [np.zeros(0, "<u4")], 0
        ends = np.cumsum(np.bincount(sizes)).tolist() if len(sizes) else []
        for size in range(1, len(ends)):
            for at in range(ends[size - 1], ends[size], most := max(1, AT_ONCE // size)):
                w = order[at : min(ends[size], at + most)]
                score[w], loss[w], count[w], some = self._best_of_length(chars[begin[w] + np.arange(size)[:, None]].astype(np.int64))
                first[w] = made + np.cumsum(count[w]) - count[w]
                made += len(some)
                ids.append(some)
        return score, loss, first, count, np.concatenate(ids)

    def _best_of_length(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``best_paths`` of words that are the columns of a table: score, loss, number of ids; and all ids."""
        size, n = chars.shape
        flat = chars.ravel()
        # For each length of a piece the table of pieces by their ends, and of their scores.
        pieces, scores = {}, {}
        begin, at = np.arange(size * n), None
        for k in range(1, min(size, self.longest) + 1):
            if k == 1:
                found = self.first_step[flat]
                alive = found >= 0
            else:
                # Behind the last character nothing begins.
                cut = np.searchsorted(begin, (size - k + 1) * n)
                begin, at = begin[:cut], at[:cut]
                found, alive = self._steps(at << 21 | flat[begin + (k - 1) * n])
            begin, found = begin[alive], found[alive]
            at, piece = self.to[found], self.ends[found]
            whole = np.flatnonzero(piece >= 0)
            if k == 1 or len(whole):
                pieces[k], scores[k] = np.full((size + 1) * n, -1, np.int32), np.full((size + 1) * n, -np.inf)
                end, piece = begin[whole] + k * n, piece[whole]
                pieces[k][end], scores[k][end] = piece, self.edge_score[piece]
            if not len(begin):
                break
        rest = np.flatnonzero(pieces[1][n:] < 0)
        kinds, kind = np.unique(flat[rest], return_inverse=True)
        bytes_of = {c: self.fallback(chr(c)) for c in kinds.tolist()}
        scores[1][rest + n] = np.array([sum(self.score[i] for i in b) for b in bytes_of.values()], float)[kind]
        # Best and second-best score of each position, the latter by another last piece or through a second best.
        front, second = np.zeros((size + 1, n)), np.full((size + 1, n), -np.inf)
        length = np.zeros((size + 1, n), np.int64)
        tables = [(k, scores[k].reshape(size + 1, n)) for k in sorted(scores, reverse=True)]
        for j in range(1, size + 1):
            best, last, other, through = np.full(n, -np.inf), length[j], second[j], np.full(n, -np.inf)
            for k, table in tables:
                if k > j:
                    continue
                total = front[j - k] + table[j]
                # Of equal scores the longest last piece, as in the search below.
                better = total > best
                np.maximum(other, np.minimum(total, best), out=other)
                np.copyto(last, k, where=better)
                np.copyto(through, second[j - k] + table[j], where=better)
                np.maximum(best, total, out=best)
            front[j] = best
            np.maximum(other, through, out=other)
        # The pieces of the best path where they begin, from the back.
        path, word, j = np.full((size, n), -2, np.int32), np.arange(n), np.full(n, size)
        while len(word):
            k = length[j, word]
            i = j - k
            for one in np.unique(k).tolist():
                of = k == one
                path[i[of], word[of]] = pieces[one][j[of] * n + word[of]]
            more = i > 0
            word, j = word[more], i[more]
        taken = path.T > -2
        ids, count = path.T[taken], taken.sum(axis=1)
        spelled = np.flatnonzero(ids < 0)
        if len(spelled):
            parts = [bytes_of[c] for c in chars.T[taken][spelled].tolist()]
            times = np.ones(len(ids), np.int64)
            times[spelled] = [len(b) for b in parts]
            count = np.bincount(np.repeat(np.arange(n), count), times, n).astype(np.int64)
            ids = np.repeat(ids, times)
            ids[ids < 0] = [i for b in parts for i in b]
        return front[-1], front[-1] - second[-1], count, ids.astype("<u4")

    def n_best(self, text: str, n: int) -> list[Segmentation]:
        """The ``n`` best segmentations of a stretch, best first; equal scores in the order of the search."""
        edges, front = self.lattice(text)
        # Of equal scores the state nearest to the front comes first, so ties are completed one by one.
        queue = [(-front[-1], len(text), 0, 0.0, None)]
        made, out = 0, []
        while queue and len(out) < n:
            _, j, _, back, path = heapq.heappop(queue)
            if j == 0:
                ids = []
                while path:
                    ids += path[0]
                    path = path[1]
                out.append((back, tuple(ids)))
                continue
            for i, s, ids in edges[j]:
                made += 1
                heapq.heappush(queue, (-(front[i] + s + back), i, made, s + back, (ids, path)))
        return out

    def stretches(self, text: str) -> list[str]:
        """Cut where two characters never stand inside one piece."""
        cuts = [k for k in range(1, len(text)) if text[k - 1 : k + 1] not in self.inside]
        return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]


class Encoder:
    """The N best segmentations of whole texts; ids are little-endian unsigned 32-bit numbers in bytes."""

    def __init__(self, path: str, n: int, scores: list[float] | None = None) -> None:
        self.vocabulary, self.n = Vocabulary(path, scores), n
        v = self.vocabulary
        raw = [bytes([v.value[i]]) if i in v.value else t.encode() for i, t in enumerate(v.text)]
        self.raw, self.raw_size = np.frombuffer(b"".join(raw), np.uint8), np.fromiter(map(len, raw), np.int64, len(raw))
        self.raw_first = np.cumsum(self.raw_size) - self.raw_size
        self.stretches: dict[str, Best] = {}
        self.words = Words()
        #: Of each word that is remembered the score, what the next best loses, where its ids are, and all ids.
        self.score, self.loss, self.first, self.count = np.zeros(0), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, "<u4")
        self.searched: dict[str, list[tuple[float, bytes]]] = {}

    @staticmethod
    def _kept(memory: dict, text: str, found):
        if len(text) <= LONGEST_KEPT:
            if len(memory) >= KEPT:
                memory.clear()
            memory[text] = found
        return found

    def _stretch(self, text: str) -> Best:
        return self.stretches.get(text) or self._kept(self.stretches, text, self.vocabulary.best(text))

    def _word(self, text: str) -> Best:
        found = [self._stretch(s) for s in self.vocabulary.stretches(text)]
        return sum(f[0] for f in found), b"".join(f[1] for f in found), min(f[2] for f in found)

    def _alternatives(self, word: str) -> list[tuple[float, bytes]]:
        """The N best of a word: of its stretches by search, merged."""
        found = self.searched.get(word)
        if found is None:
            parts = [[(s, np.array(ids, "<u4").tobytes()) for s, ids in self.vocabulary.n_best(t, self.n)]
                     for t in self.vocabulary.stretches(word)]
            found = self._kept(self.searched, word, self._merge(parts))
        return found

    def _merge(self, parts: list[list[tuple[float, bytes]]]) -> list[tuple[float, bytes]]:
        """The N best of a row of parts from the N best of each, best first."""
        merged: list[tuple[float, tuple[int, ...]]] = [(0.0, ())]
        for p in parts:
            merged = sorted((a + p[0][0] - s, c + (i,)) for a, c in merged for i, (s, _) in enumerate(p))[: self.n]
        best = sum(p[0][0] for p in parts)
        return [(best - lost, b"".join(p[i][1] for p, i in zip(parts, choice))) for lost, choice in merged]

    def _learn(self, before: int) -> None:
        """The best of the words that are new, from number ``before`` on; very long ones are worked on one by one."""
        places, data = buffers(self.words.known[before:])
        text = data.tobytes().decode("utf-8", "surrogatepass").replace(" ", SPACE)
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        leads = np.append(0, np.cumsum(data & 0xC0 != 0x80))
        ends = leads[places]
        sizes = np.diff(ends)
        listed = sizes <= LONGEST_KEPT
        score, loss, first, count, ids = self.vocabulary.best_paths(chars[np.repeat(listed, sizes)], np.where(listed, sizes, 0))
        parts, made = [ids], len(ids)
        for w in np.flatnonzero(~listed).tolist():
            score[w], found, loss[w] = self._word(chars[ends[w] : ends[w + 1]].tobytes().decode("utf-32-le", "surrogatepass"))
            parts.append(np.frombuffer(found, "<u4"))
            first[w], count[w] = made, len(parts[-1])
            made += len(parts[-1])
        if not before:
            self.ids = self.ids[:0]
        first += len(self.ids)
        self.ids = np.concatenate([self.ids, *parts])
        self.score, self.loss, self.first, self.count = (np.concatenate([old[:before], some]) for old, some in (
            (self.score, score), (self.loss, loss), (self.first, first), (self.count, count)))

    def encode(self, text: str) -> list[tuple[float, bytes]]:
        """The N best of a text: score and ids, best first. An empty text has one, without ids."""
        return self.encode_texts([blanked(text)])[0]

    def encode_texts(self, texts: list[bytes]) -> list[list[tuple[float, bytes]]]:
        """The N best of each of a run of blanked texts."""
        words, ends, before = self.words.number(texts)
        if len(self.words.known) > before:
            self._learn(before)
        score, loss, count = self.score[words].tolist(), self.loss[words], self.count[words]
        upto = np.append(0, 4 * np.cumsum(count)).tolist()
        data = self.ids[ranges(self.first[words], count)].tobytes()

        def fixed(a: int, b: int) -> list[tuple[float, bytes]]:
            return [(sum(score[a:b]), data[upto[a] : upto[b]])]

        out = []
        for at, end in zip(ends[:-1].tolist(), ends[1:].tolist()):
            parts = []
            for k in (self._open(loss[at:end]) + at).tolist():
                word = self.words.known[int(words[k])].as_py().decode("utf-8", "surrogatepass").replace(" ", SPACE)
                parts += [fixed(at, k), self._alternatives(word)]
                at = k + 1
            out.append(self._merge([*parts, fixed(at, end)]))
        return out

    def _open(self, loss: np.ndarray) -> np.ndarray:
        """Another segmentation can only be among the N best if its word loses among the least: these words."""
        if self.n < 2 or not len(loss):
            return np.zeros(0, np.int64)
        least = np.sort(np.partition(loss, self.n - 2)[: self.n - 1] if self.n <= len(loss) else loss)
        # Of equal losses the first words.
        below = np.flatnonzero(loss < least[-1])
        ties = np.flatnonzero(loss == least[-1])[: max(0, self.n - 1 - len(below))]
        found = np.sort(np.append(below, ties))
        return found[loss[found] != np.inf]

    def spelled(self, ids: bytes) -> bytes:
        """The pieces of ids, joined, in UTF-8."""
        found = np.frombuffer(ids, "<u4")
        return self.raw[ranges(self.raw_first[found], self.raw_size[found])].tobytes()

    def decode(self, ids: bytes) -> str:
        """The text of ids: pieces joined, runs of byte pieces read as UTF-8, the leading blank taken off."""
        text = self.spelled(ids).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


def piece_log_probabilities(docs: DataFrame, model: str) -> list[float]:
    """The log-probability of each piece of the vocabulary, in order of the ids.

    Pieces are counted in the library's segmentation of all whole texts, once more than seen, so unseen ones are possible.
    NULL and empty texts have none. The list has the length of the vocabulary, whatever the table.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = Vocabulary(model)
        n = np.zeros(len(vocabulary.text), np.int64)
        words, times = Words(), np.zeros(0, np.int64)
        for texts in _texts(batch["text"] for batch in batches):
            last = words.known
            found, _, before = words.number(texts)
            if before < len(last):
                n += vocabulary.library_counts(last, times)
            times = np.bincount(found, minlength=len(words.known)) + np.append(
                times[:before], np.zeros(len(words.known) - before, np.int64))
        n += vocabulary.library_counts(words.known, times)
        seen = np.flatnonzero(n)
        yield pd.DataFrame({"piece": seen, "n": n[seen]})

    counted = docs.select(F.col("text").cast("string").alias("text")).mapInPandas(run, "piece long, n long")
    found = counted.groupBy("piece").agg(F.sum("n").alias("n")).collect()
    n = np.ones(len(Vocabulary(model).text))
    for r in found:
        n[r["piece"]] += r["n"]
    return np.log(n / n.sum()).tolist()


def _texts(columns: Iterator[pd.Series]) -> Iterator[list[bytes]]:
    """Runs of blanked texts."""
    for column in columns:
        texts = [t or "" for t in column]
        for a, b in runs(texts, RUN):
            yield [blanked(t) for t in texts[a:b]]


def _encoded(batches: Iterator[pd.DataFrame], encoder: Encoder) -> Iterator[tuple[pd.DataFrame, list[bytes], list]]:
    """Runs of rows with their blanked texts and the N best of each."""
    for batch in batches:
        at = 0
        for texts in _texts(iter([batch["text"]])):
            yield batch.iloc[at : at + len(texts)], texts, encoder.encode_texts(texts)
            at += len(texts)


def encode_n_best(docs: DataFrame, model: str, n: int = 4, scores: list[float] | None = None) -> DataFrame:
    """``doc_id, text, scores, ids``: the ``n`` best segmentations of each text, best first.

    ``model`` is the path of a model that every executor has; ``scores`` are those of its pieces, as
    ``piece_log_probabilities`` gives them, else the model's own. A NULL or empty text has one segmentation, with
    score 0 and no ids; a text with fewer than ``n`` segmentations has all of them. Repeated rows are encoded alike,
    other columns are ignored, an empty table gives an empty result.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, _, found in _encoded(batches, Encoder(model, n, scores)):
            yield rows.assign(doc_id=rows["doc_id"].astype("Int64"), scores=[[s for s, _ in f] for f in found],
                              ids=[[np.frombuffer(i, "<u4").astype(np.int32) for _, i in f] for f in found])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(run, "doc_id long, text string, scores array<double>, ids array<array<int>>")


def decode(rows: DataFrame, model: str, column: str = "ids") -> DataFrame:
    """The rows with ``decoded``, the text of the ids in ``column``; NULL ids give the empty text."""
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(model, 1)
        for ids in parts:
            yield pd.Series([encoder.decode(np.asarray(x if x is not None else [], "<u4").tobytes()) for x in ids])

    return rows.withColumn("decoded", F.pandas_udf(run, "string")(F.col(column)))


def encoding_digest(docs: DataFrame, model: str, n: int = 4) -> DataFrame:
    """``doc_id, n_ids, ids_crc32, scores, crc32s, round_trip`` of each document.

    Pieces score their log-probabilities in ``docs``. ``n_ids`` and ``ids_crc32`` are of the best segmentation, ``scores``
    and ``crc32s`` of all ``n`` (ids as little-endian unsigned 32-bit numbers); ``round_trip`` is whether the best decodes to
    the text, in which the vocabulary's blank sign stands for a blank. Rows are handled as in ``encode_n_best``.
    """
    scores = piece_log_probabilities(docs, model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(model, n, scores)
        for rows, texts, encoded in _encoded(batches, encoder):
            out = []
            for text, found in zip(texts, encoded):
                crcs = [zlib.crc32(ids) for _, ids in found]
                # No word holds a blank, and only bytes of the text itself stand for characters: the bytes tell the texts apart.
                whole = text.replace(b" ", SPACE.encode())
                out.append((len(found[0][1]) // 4, crcs[0], [s for s, _ in found], crcs, encoder.spelled(found[0][1]) == whole))
            frame = pd.DataFrame(out, columns=["n_ids", "ids_crc32", "scores", "crc32s", "round_trip"])
            frame.insert(0, "doc_id", rows["doc_id"].astype("Int64").array)
            yield frame

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(run, "doc_id long, n_ids long, ids_crc32 long, scores array<double>, crc32s array<long>, round_trip boolean")
