"""SentencePiece BPE encoding and decoding with a table of each prefix's last token.

Byte-pair merging of a text has, for every prefix of the text, exactly one encoding, so exactly one last token.
The table keeps that token for each prefix. The token ending at position i is the one vocabulary match ending
there that may stand after the last token of the prefix before it: merging the two tokens' texts together must
leave the border between them alone. Matches come from an Aho-Corasick automaton; whether two tokens may stand
together is decided from how each was merged. The ids are then read backwards from the end of the table.

Pieces of the supported models never hold a space mark after another character, so a text falls apart into
pre-tokens (a run of space marks and what follows it) that are encoded alone, once each while they are cached.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

SPACE = "▁"
NORMAL, BYTE = 1, 6
#: Pre-tokens of a text whose spaces are marks. A line feed is in no piece, so it is a border as well.
PRE_TOKEN = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n+|[^{SPACE}\n]+")
#: Pre-tokens that a worker keeps; beyond it the cache starts anew, so that memory stays bounded.
CACHE_ENTRIES = 500_000
#: Pairs of tokens that a worker keeps the answer for, some 200 bytes each.
FIT_ENTRIES = 1_000_000
#: Longer pre-tokens are not kept, so that entries have a bound in bytes as well.
CACHED_CHARS = 200


def marked(text: str) -> str:
    """The text as the library merges it: a leading space mark, and a mark for each space."""
    return (SPACE + text).replace(" ", SPACE) if text else ""


#: Bytes of a text that are cut into pre-tokens at once.
PART_BYTES = 1 << 20
#: Where a text may be cut: before a run of spaces (or their marks) or of line feeds, both of which begin a pre-token.
_CUT = re.compile(rb"[^ ](?<!\xe2\x96\x81)(?= )|[^\n](?=\n)")


def pre_token_parts(data: bytes, size: int = PART_BYTES) -> Iterator[list[str]]:
    """The pre-tokens of a text in UTF-8, in lists of those of about `size` bytes; a longer pre-token stays whole.

    Bytes that are no UTF-8 become U+FFFD.
    """
    at = 0
    while at < len(data):
        found = _CUT.search(data, at + size) if at + size < len(data) else None
        end = found.end() if found else len(data)
        part = data[at:end].decode("utf-8", "replace")
        yield PRE_TOKEN.findall(marked(part) if at == 0 else part.replace(" ", SPACE))
        at = end


class PieceModel:
    """A SentencePiece BPE model with byte fallback and the identity normaliser."""

    def __init__(self, path: str):
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        norm = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or norm.precompiled_charsmap or not norm.add_dummy_prefix or norm.remove_extra_whitespaces or not proto.trainer_spec.byte_fallback:
            raise ValueError("only BPE models with byte fallback, a dummy prefix and no normalisation are supported")
        self.pieces = [p.piece for p in proto.pieces]
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        score = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.runs = [p for p in self.ids if len(p) > 1 and not p.strip(SPACE)]
        for piece in self.ids:
            if SPACE in piece.lstrip(SPACE) or "\n" in piece or (piece.startswith(SPACE * 2) and piece.strip(SPACE)):
                raise ValueError(f"piece {piece!r} crosses the border of a pre-token")
        longest, self.longest_run = max(map(len, self.runs), default=1), 10**9
        if self._run(longest) != [longest]:
            raise ValueError("merging from the left does not make the longest run of space marks")
        self.longest_run = longest
        words = [p for p in self.ids if len(p) == 1 or p.strip(SPACE)]
        if len({score[p] for p in words if len(p) > 1}) != sum(len(p) > 1 for p in words):
            raise ValueError("two pieces have the same score")
        ordered = sorted((p for p in words if len(p) > 1), key=lambda p: -score[p])
        #: When a piece is merged: 0 for single characters, then by falling score.
        self.rank = {p: 0 for p in words if len(p) == 1} | {p: n for n, p in enumerate(ordered, 1)}
        self._fits: dict[tuple[str, str], bool] = {}
        self.halves: dict[str, tuple[str, str]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece in sorted(words, key=lambda p: self.rank[p]):
            if len(piece) > 1:
                merged = self._halves(piece)
                if merged is None:
                    continue  # no merge leads to it, so no text holds it
                self.halves[piece] = merged
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()

    def _halves(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose merge makes `piece`, found by merging its characters by rank, leftmost first."""
        parts = list(piece)
        while len(parts) > 2:
            best = min(((self.rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.rank), default=None)
            if best is None or best[0] >= self.rank[piece]:
                return None
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return (parts[0], parts[1])

    def _run(self, marks: int) -> list[int]:
        """Lengths of the pieces that a run of space marks is merged to: all have one score, so the leftmost pair goes first."""
        whole, rest = divmod(marks, self.longest_run)
        parts, known = [1] * rest, {len(p) for p in self.runs}
        while (i := next((i for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in known), None)) is not None:
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.longest_run] * whole + parts

    def fits(self, left: str, right: str) -> bool:
        """Whether merging leaves a border between two tokens that stand together.

        Their merges are undone from the latest on. As long as the parts at the border would be merged with each
        other only later than with their own neighbours, the border holds; at equal rank the left pair goes first.
        """
        known = self._fits.get((left, right))
        if known is not None:
            return known
        a, b, result = left, right, True
        until_a = until_b = float("inf")  # when the part at the border is merged with its own neighbour
        while True:
            together = self.rank.get(a + b)
            if together is not None and together < until_a and together <= until_b:
                result = False
                break
            rank_a, rank_b = self.rank.get(a, 0), self.rank.get(b, 0)
            if rank_a == 0 and rank_b == 0:
                break
            if rank_a >= rank_b:
                until_a, a = rank_a, self.halves[a][1]
            else:
                until_b, b = rank_b, self.halves[b][0]
        if len(self._fits) < FIT_ENTRIES:
            self._fits[left, right] = result
        return result

    def _tokens(self, word: str) -> list[str]:
        """Pieces, or single unknown characters, of a word with one space mark at most."""
        last: list[str] = [""]  # last[i]: the last token of the first i characters
        fits = self.fits
        for end, piece in self.automaton.iter(word):
            while len(last) <= end:  # characters in no piece: nothing merges with them
                last.append(word[len(last) - 1])
            if len(last) == end + 1:
                start = end + 1 - len(piece)
                if start == 0 or fits(last[start], piece):
                    last.append(piece)
        last += word[len(last) - 1 :]
        back, at = [], len(word)
        while at:
            back.append(last[at])
            at -= len(last[at])
        return back[::-1]

    def encode_pre_token(self, chunk: str) -> list[int]:
        """Ids of one pre-token. Pieces of space marks only have the lowest score, so they are merged last, from the left."""
        if chunk[0] == "\n":
            return [self.bytes[10]] * len(chunk)
        marks = len(chunk) - len(chunk.lstrip(SPACE))
        tokens = self._tokens(chunk[marks - 1 :] if marks else chunk)
        if marks > 1:
            alone = marks if tokens[0] == SPACE else marks - 1
            tokens = [SPACE * n for n in self._run(alone)] + tokens[alone - marks + 1 :]
        out = []
        for token in tokens:
            known = self.ids.get(token)
            out.extend([known] if known is not None else [self.bytes[b] for b in token.encode("utf-8", "surrogatepass")])
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a text, as the library gives them without begin and end."""
        return [i for chunk in PRE_TOKEN.findall(marked(text)) for i in self.encode_pre_token(chunk)]

    def surface(self, ids: list[int]) -> str:
        """Text behind ids, with the space that the encoder puts in front."""
        out, held = [], bytearray()
        for i in ids:
            byte = self.byte_of.get(i)
            if byte is not None:
                held.append(byte)
                continue
            if held:
                out.append(_decoded(held))
                held = bytearray()
            out.append(self.pieces[i])
        if held:
            out.append(_decoded(held))
        return "".join(out).replace(SPACE, " ")

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the first space goes, being the encoder's own."""
        text = self.surface(ids)
        return text[1:] if text.startswith(" ") else text


def _decoded(held: bytes) -> str:
    """Bytes as UTF-8; each byte that is part of no character becomes U+FFFD."""
    out, at = [], 0
    while at < len(held):
        for size in (1, 2, 3, 4):
            try:
                out.append(bytes(held[at : at + size]).decode("utf-8"))
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    """The model of a file, built once in each worker."""
    return PieceModel(path)


class EncodedPreTokens(dict):
    """Pre-token → (ids as text, its surface), filled on demand and emptied when full."""

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model = model

    def __missing__(self, chunk: str) -> tuple[str, str]:
        ids = self.model.encode_pre_token(chunk)
        found = (",".join(map(str, ids)), self.model.surface(ids))
        if len(chunk) <= CACHED_CHARS:
            self[chunk] = found
        return found


@lru_cache(maxsize=2)
def pre_token_cache(path: str) -> EncodedPreTokens:
    return EncodedPreTokens(piece_model(path))


@lru_cache(maxsize=2)
def library(path: str) -> sentencepiece.SentencePieceProcessor:
    """The library's own encoder, for counting pieces of single pre-tokens."""
    return sentencepiece.SentencePieceProcessor(model_file=path)
