"""SentencePiece encoding and decoding for merge-type vocabularies.

A text gets a space in front, spaces become a visible mark, and the characters are the first symbols. An agenda holds
the adjacent pairs whose union is a piece, ordered by the piece's score and then from the left; the best pair is
merged and its new neighbours enter, until none is left. Symbols that are no piece fall back to their UTF-8 bytes.

No piece of such a vocabulary has a mark behind another character (checked when it is loaded), so no merge crosses
the start of a run of marks: a text is the sequence of its runs of marks with the word that follows. For the same
reason such a segment is cut between characters that no piece has side by side, mostly punctuation from words. Distinct
segments and parts are worked out once and remembered, up to ``REMEMBERED`` of them and as many of the period before
in a task's worker.

Some rows of each Arrow batch (every ``check_every``-th, the first included) are held against the sentencepiece
library, ids and decoded text; a difference ends the job. Null and empty texts have no ids and decode to the empty
text. Rows are encoded one by one, so repeated rows and null ids each get their own result.
"""

from __future__ import annotations

import re
from functools import lru_cache
from hashlib import sha256
from heapq import heapify, heappop, heappush
from operator import add

import public_tokenizers
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import schema_of, text_function

MODEL = "piece_bpe_32k.model"
MARK = "▁"
SEGMENT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
REMEMBERED = 250_000
CHECK_EVERY = 256
IDS = "n_tokens long, ids array<int>, decoded string"
DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"
Part = tuple[tuple[int, ...], bytes, bytes]
#: A heap pays off for more symbols than this.
FEW = 32
#: Behind every order of a pair.
NEVER = 1 << 62


class Vocabulary:
    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        library = self.library
        pieces = [library.id_to_piece(i) for i in range(library.get_piece_size())]
        plain = [
            i
            for i in range(len(pieces))
            if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i))
        ]
        if any(MARK in pieces[i].lstrip(MARK) for i in plain):
            raise ValueError("a piece has a space behind another character; texts can't be cut at spaces")
        self.ids = {pieces[i]: i for i in plain}
        # Equal scores share a place in the agenda's order, where the pair further left comes first.
        scores = sorted({library.get_score(i) for i in plain}, reverse=True)
        order = {score: n for n, score in enumerate(scores)}
        self.order = {pieces[i]: order[library.get_score(i)] << 32 for i in plain}
        self.byte_ids = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes = [piece.replace(MARK, " ").encode() for piece in pieces]
        for value, i in enumerate(self.byte_ids):
            self.bytes[i] = bytes([value])
        self.together = {pair for piece in self.ids for pair in map(add, piece, piece[1:])}
        # What this period worked out, and the one before. The first is never replaced, only emptied.
        self.known: dict[str, Part] = {}
        self.older: dict[str, Part] = {}

    def merged(self, symbols: list[str]) -> list[str]:
        """Merge pairs in the agenda's order. An entry is the pair's order and its left place in one number."""
        order = self.order
        n = len(symbols)
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        unions = map(add, symbols, symbols[1:])
        agenda = [order[union] + i for i, union in enumerate(unions) if union in order]
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            left = entry & 0xFFFFFFFF
            right = following[left]
            if right >= n:
                continue
            # An entry is out of date if its pair has changed since; what it should have been is in its place.
            union = symbols[left] + symbols[right]
            if order.get(union, -1) + left != entry:
                continue
            symbols[left], symbols[right] = union, ""
            end = following[left] = following[right]
            following[right] = n
            if end < n:
                before[end] = left
                ahead = union + symbols[end]
                if ahead in order:
                    heappush(agenda, order[ahead] + left)
            start = before[left]
            if start >= 0:
                behind = symbols[start] + union
                if behind in order:
                    heappush(agenda, order[behind] + start)
        return [symbol for symbol in symbols if symbol]

    def merged_few(self, symbols: list[str]) -> list[str]:
        """The same for few symbols: the agenda holds each pair's order in the pair's place, its best is looked for."""
        order = self.order
        agenda = [order.get(union, NEVER) for union in map(add, symbols, symbols[1:])]
        while agenda and (best := min(agenda)) != NEVER:
            left = agenda.index(best)
            union = symbols[left] = symbols[left] + symbols.pop(left + 1)
            del agenda[left]
            if left < len(agenda):
                agenda[left] = order.get(union + symbols[left + 1], NEVER)
            if left:
                agenda[left - 1] = order.get(symbols[left - 1] + union, NEVER)
        return symbols

    def part(self, text: str) -> Part:
        """Ids of a part, the same as decimal numbers with a comma behind each, and what they decode to."""
        ids: list[int] = []
        for piece in (self.merged_few if len(text) <= FEW else self.merged)(list(text)):
            found = self.ids.get(piece)
            ids.extend([found] if found is not None else [self.byte_ids[b] for b in piece.encode()])
        return tuple(ids), b"".join([b"%d," % i for i in ids]), b"".join([self.bytes[i] for i in ids])

    def cut(self, text: str) -> list[str]:
        """A segment in parts that no merge can join: two characters that no piece has side by side stay apart."""
        together, pairs = self.together, list(map(add, text, text[1:]))
        if together.issuperset(pairs):
            return [text]
        cuts = [i for i, pair in enumerate(pairs, 1) if pair not in together]
        return [text[i:j] for i, j in zip([0, *cuts], [*cuts, len(text)])]

    def remembered(self, text: str) -> Part | None:
        """A result of this or of the last period, the latter taken over."""
        found = self.known.get(text)
        if found is None and (found := self.older.get(text)) is not None:
            self.remember(text, found)
        return found

    def remember(self, text: str, result: Part) -> None:
        if len(self.known) >= REMEMBERED:
            self.older = self.known.copy()
            self.known.clear()
        self.known[text] = result

    def segment(self, text: str) -> Part:
        """As ``part``, for a segment that is not among this period's."""
        if (found := self.remembered(text)) is not None:
            return found
        results = []
        for cut in self.cut(text):
            if (result := self.remembered(cut)) is None:
                result = self.part(cut)
                self.remember(cut, result)
            results.append(result)
        if len(results) == 1:
            return results[0]
        ids, numbers, decoded = zip(*results)
        joined = tuple([i for some in ids for i in some]), b"".join(numbers), b"".join(decoded)
        self.remember(text, joined)
        return joined

    def encoded(self, text: str) -> list[Part]:
        if not text:
            return []
        known, segment = self.known, self.segment
        return [known.get(part) or segment(part) for part in SEGMENT.findall(MARK + text.replace(" ", MARK))]

    def encode(self, text: str) -> list[int]:
        return [i for ids, _, _ in self.encoded(text) for i in ids]

    def decode(self, ids: list[int]) -> str:
        """The text of any ids of the vocabulary; bytes that are no UTF-8 become U+FFFD, one for each."""
        data = b"".join([self.bytes[i] for i in ids if not self.library.is_control(i)])
        return as_text(data)

    def check(self, text: str, ids: list[int], decoded: str) -> None:
        if ids != self.library.encode(text) or decoded != self.library.decode(ids):
            raise ValueError(f"the library encodes this text differently: {text[:200]!r}")


def as_text(data: bytes) -> str:
    """Without the space that encoding puts in front."""
    data = data[1:] if data[:1] == b" " else data
    try:
        return data.decode()
    except UnicodeDecodeError:
        # A byte piece that belongs to no character stands for one U+FFFD.
        return re.sub("[\udc80-\udcff]", "�", data.decode(errors="surrogateescape"))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """Loaded once in a worker, from where the tokenizers are installed on its machine."""
    return Vocabulary(path)


def pieces(
    text: str | Column, model: str = MODEL, digests: bool = False, check_every: int = CHECK_EVERY
) -> Column:
    """A struct of ids and decoded text, or of their digests, for a text column."""

    def measure(texts: list[bytes]) -> list[dict]:
        words = vocabulary(public_tokenizers.path(model))
        records = []
        for n, data in enumerate(texts):
            text = data.decode()
            parts = words.encoded(text)
            decoded = b"".join([part[2] for part in parts])
            decoded = decoded[1:] if decoded[:1] == b" " else decoded
            size = sum([len(part[0]) for part in parts])
            if n % check_every == 0:
                words.check(text, [i for part in parts for i in part[0]], as_text(b" " + decoded))
            if digests:
                numbers = b"".join([part[1] for part in parts])[:-1]
                records.append(
                    {
                        "n_tokens": size,
                        "ids_sha256": sha256(numbers).hexdigest(),
                        "decoded_sha256": sha256(decoded).hexdigest(),
                    }
                )
            else:
                ids = [i for part in parts for i in part[0]]
                records.append({"n_tokens": size, "ids": ids, "decoded": decoded.decode()})
        return records

    return text_function(measure, schema_of(DIGESTS if digests else IDS))(text)


def encode(
    docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = MODEL, digests: bool = False
) -> DataFrame:
    """Key, ids and decoded text of each row, or with ``digests`` the SHA-256 of both."""
    return docs.select(F.col(key), pieces(F.col(text), model, digests).alias("pieces")).select(key, "pieces.*")
