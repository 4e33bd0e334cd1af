"""A BPE piece model compiled, as far as texts need it, into a deterministic transducer.

BPE merges the adjacent symbols whose joined string is the best-scored piece, leftmost
first. A sequence of pieces is therefore a text's encoding just when each two neighbours
are the encoding of their joined string, and each prefix has one last piece. A state is
what that rule needs of the text read so far: the characters that may still grow into
a piece and, for each place where a piece may start, the last piece before it and how many
tokens were emitted up to there, relative to now. Reading a character leads to one next
state and emits a token count (it may be negative, where earlier pieces merge).

A space before a word and a character that occurs in no longer piece lead to the same
state from every state, so a chunk's state map is constant beyond its first such place:
(head, count, tail), where ``head`` is read from the state that the chunk is entered in,
``count`` holds between the two, and ``tail``, read from the start state, names the state
that the chunk is left in. Composing two maps reads one head from one tail's state.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = "▁"
#: Entries that the tables of neighbours and words may hold before they are emptied; steps take twice as many.
CACHE = 300_000


class Transducer:
    def __init__(self, model_file: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        plain = [i for i in range(sp.get_piece_size())
                 if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        longer = [p for p in self.score if len(p) > 1]
        inner = {p for p in longer if SPACE in p[1:] and p.strip(SPACE)}
        if inner:
            raise ValueError(f"pieces with a space inside them aren't supported: {sorted(inner)[:3]}")
        self.starts = {p[:k] for p in longer for k in range(1, len(p))}
        self.fits: dict[tuple[str, str], bool] = {}
        #: States by number, their numbers, and the known transitions: state number and character to next state's number and count.
        self.states: list[tuple] = [("", ((0, "", 0),))]
        self.numbers: dict[tuple, int] = {self.states[0]: 0}
        self.steps: dict[int, tuple[int, int]] = {}
        self.words: dict[str, int] = {}
        # Pieces of equal score (runs of spaces) are merged by definition, all others by their order.
        self.rank: dict[str, int] = {}
        self.parts: dict[str, tuple[str, str]] = {}
        self.tied = {p for p in longer if not p.strip(SPACE)}
        for p in sorted(longer, key=lambda p: -self.score[p]):
            if p not in self.tied:
                self._add(p)

    def _add(self, piece: str) -> None:
        """Find the last merge that makes a piece; pieces that no merge makes are left out."""
        for k in range(1, len(piece)):
            a, b = piece[:k], piece[k:]
            known = (len(a) == 1 or a in self.rank) and (len(b) == 1 or b in self.rank)
            if known and self._ordered(a, b):
                self.parts[piece] = (a, b)
                self.rank[piece] = len(self.rank) + 1
                return

    def weight(self, piece: str) -> int:
        """Tokens that a piece stands for: a character without a piece gives its bytes."""
        return 1 if piece in self.score else len(piece.encode())

    def merge(self, symbols: list[str]) -> list[str]:
        """BPE by its definition, for two joined pieces."""
        symbols = list(symbols)
        while True:
            best = None
            for i in range(len(symbols) - 1):
                s = self.score.get(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best[0]):
                    best = (s, i)
            if best is None:
                return symbols
            i = best[1]
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]

    def _ordered(self, a: str, b: str) -> bool:
        """Whether pieces a and b stay apart: no merge across their border comes before the merges that made them.

        Undoes their merges from the last one back and looks at the two symbols that then meet at the border.
        """
        rank, parts = self.rank, self.parts
        limit = 1 << 60
        while True:
            both = a + b
            if parts.get(both) == (a, b) and rank[both] < limit:
                return False
            ra, rb = rank.get(a, 0), rank.get(b, 0)
            if not ra and not rb:
                return True
            if ra > rb:
                limit, a = ra, parts[a][1]
            else:
                limit, b = rb + 1, parts[b][0]

    def follows(self, a: str, b: str) -> bool:
        """Whether the encoding of a + b is these two pieces (for an empty a: whether b is its own encoding)."""
        got = self.fits.get((a, b))
        if got is None:
            if len(self.fits) > CACHE:
                self.fits.clear()
            if not a:
                got = len(b) == 1 or b in self.rank or b in self.tied
            elif b[0] == SPACE and (a[-1] == SPACE or b[1:2] == SPACE) or a in self.tied:
                got = self.merge([*a, *b]) == [a, b]
            else:
                got = self._ordered(a, b)
            self.fits[a, b] = got
        return got

    def _compile(self, state: int, c: str) -> tuple[int, int]:
        """A new transition; emptied tables keep no state but the start."""
        to, n = self._step(self.states[state], c)
        number = self.numbers.get(to)
        if number is None:
            number = self.numbers[to] = len(self.states)
            self.states.append(to)
        got = self.steps[state << 21 | ord(c)] = (number, n)
        return got

    def _step(self, state: tuple, c: str) -> tuple[tuple, int]:
        text, places = state
        text += c
        rank, tied, starts = self.rank, self.tied, self.starts
        for at, last, count in places:
            piece = text[at:]
            if (piece in rank or piece in tied or len(piece) == 1) and self.follows(last, piece):
                count += self.weight(piece)
                break
        else:
            raise AssertionError("no piece fits")
        kept = [(i, p, n - count) for i, p, n in places if text[i:] in starts]
        cut = kept[0][0] if kept else len(text)
        return (text[cut:], (*((i - cut, p, n) for i, p, n in kept), (len(text) - cut, piece, 0))), count

    def read(self, text: str) -> int:
        """Token count of a piece of text, read from the start state."""
        if len(self.steps) > 2 * CACHE:
            self.steps.clear()
            del self.states[1:]
            self.numbers = {self.states[0]: 0}
        state, n, known = 0, 0, self.steps.get
        for c in text:
            state, more = known(state << 21 | ord(c)) or self._compile(state, c)
            n += more
        return n

    def word(self, text: str) -> int:
        """`read`, remembered: one long transition from the start state."""
        n = self.words.get(text)
        if n is None:
            if len(self.words) > CACHE:
                self.words.clear()
            n = self.read(text)
            if len(text) <= 64:
                self.words[text] = n
        return n

    def line(self, text: str) -> int:
        """Token count of a line that starts in the start state."""
        return sum(map(self.word, re.findall(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+", text.replace(" ", SPACE))))

    def count(self, texts: pa.Array) -> np.ndarray:
        """Token counts of texts that each start in the start state (for many texts at once)."""
        if not len(texts):
            return np.empty(0, np.int64)
        by_line = pc.split_pattern(texts, "\n")
        cuts = np.asarray(by_line.offsets)
        lines = by_line.values
        odd = np.asarray(pc.match_substring_regex(lines, f"  |{SPACE}"))
        split = pc.split_pattern(lines, " ")
        ends = np.asarray(split.offsets)
        coded = split.values.dictionary_encode()
        own, at = coded.dictionary.to_pylist(), np.asarray(coded.indices)
        first = np.zeros(len(at), bool)
        first[ends[:-1]] = True
        bare = np.zeros(len(own), np.int64)
        used = np.unique(at[first])
        bare[used] = [self.word(own[i]) for i in used]
        led = np.zeros(len(own), np.int64)
        used = np.unique(at[~first])
        led[used] = [self.word(SPACE + own[i]) for i in used]
        n = np.where(first, bare[at], led[at])
        per_line = np.add.reduceat(n, ends[:-1])
        for i in np.flatnonzero(odd):
            per_line[i] = self.line(lines[int(i)].as_py())
        end = self.word("\n")
        return np.add.reduceat(per_line, cuts[:-1]) + end * (np.diff(cuts) - 1)

    def chunk_map(self, chunk: str) -> tuple[str, str | None, str]:
        """(head, middle, tail) of a chunk; no middle: the chunk has no place that resets the state."""
        resets = re.compile(f"(?<=[^ {SPACE}])[ {SPACE}]|\n")
        m = resets.search(chunk)
        if m is None:
            return chunk, None, ""
        last = max(chunk.rfind("\n"), m.start())
        i = len(chunk)
        while i > last:  # the last place where a run of spaces begins
            i = max(chunk.rfind(" ", last, i), chunk.rfind(SPACE, last, i))
            if i <= last:
                break
            while i > last and chunk[i - 1] in (" ", SPACE):
                i -= 1
            if i > last and chunk[i - 1] not in (" ", SPACE):
                last = i
                break
        return chunk[:m.start()], chunk[m.start():last], chunk[last:]


def compose(a: tuple, b: tuple, count) -> tuple:
    """The map of two chunks in a row; ``count`` reads a text from the start state."""
    if b[1] is None:
        return (a[0] + b[0], None, "") if a[1] is None else (a[0], a[1], a[2] + b[0])
    if a[1] is None:
        return a[0] + b[0], b[1], b[2]
    return a[0], a[1] + count(a[2] + b[0]) + b[1], b[2]


def scan(maps: list[tuple], count) -> tuple:
    """The map of all chunks in order: neighbours are composed in parallel steps, as a balanced tree."""
    while len(maps) > 1:
        maps = [compose(*maps[i:i + 2], count) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
    return maps[0]
