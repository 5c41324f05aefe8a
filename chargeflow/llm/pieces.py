"""A piece vocabulary and the merges of texts to its pieces."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SPACE = "▁"

#: A finite place of a transfer matrix: begin and end of the piece over a border, the same of the next border.
Step = tuple[int, int, int, int]


def product(left: list[Step], right: list[Step]) -> list[Step]:
    """Max-plus product of transfer matrices, of which the finite places are given. It is associative."""
    after: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for a, b, c, d in right:
        after.setdefault((a, b), []).append((c, d))
    return [(a, b, *s) for a, b, c, d in left for s in after.get((c, d), ())]


def best_path(matrices: list[list[Step]], first: tuple[int, int], last: tuple[int, int] | None = None) -> list[Step]:
    """The step in each of consecutive matrices of the only finite path from ``first`` (to ``last``)."""
    reached = [{first}]
    for m in matrices:
        reached.append({(c, d) for a, b, c, d in m if (a, b) in reached[-1]})
    if last is None:
        (last,) = reached[-1]
    out = []
    for m, at in zip(matrices[::-1], reached[-2::-1]):
        out.append(next(s for s in m if s[2:] == last and s[:2] in at))
        last = out[-1][:2]
    return out[::-1]


@dataclass(frozen=True)
class Decoder:
    """What decoding needs of a vocabulary: the bytes of each piece."""

    raw: list[bytes]
    prefix: bool

    def decode(self, ids: np.ndarray) -> str:
        raw = self.raw
        out = b"".join([raw[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return out[1:] if self.prefix and out[:1] == " " else out


class Pieces:
    """Pieces of a SentencePiece model of the BPE kind, whose scores are ranks of
    merges, and the encoding of that model: the pair of neighbours of the best rank
    merges first, the leftmost of equal ones.

    A split of a text is that encoding if and only if each two neighbours, merged
    by themselves, stay the same two pieces: merges never undo and keep their order
    in a part of a text, so the first merge over a border would happen between its
    two pieces alone. Hence splits of overlapping parts that share a piece at one
    place are joined there, and the pieces over two borders of a chunk are the
    states of an exact scan (``transfer``)."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str], prefix: bool = True, model: bytes = b""):
        self.id = {p: i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == "normal"}
        self.score = np.array(scores, np.float64)
        self.prefix, self.model, self.merges = prefix, model, None
        self.raw = [bytes([int(p[3:5], 16)]) if k == "byte" else p.replace(SPACE, " ").encode() if k == "normal" else " ⁇ ".encode() if k == "unknown" else b"" for p, k in zip(pieces, kinds)]
        # Characters of each piece: a character without a piece is its bytes, of which the first counts.
        self.width = np.array([len(p) if k == "normal" else int(k == "byte" and int(p[3:5], 16) & 0xC0 != 0x80) for p, k in zip(pieces, kinds)])
        self.longest = max(map(len, self.id), default=1)

    @classmethod
    def load(cls, model_file: str) -> Pieces:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        m = SentencePieceProcessor(model_file=model_file)
        n = range(m.get_piece_size())
        kinds = ["unknown" if m.is_unknown(i) else "control" if m.is_control(i) else "byte" if m.is_byte(i) else "unused" if m.is_unused(i) else "normal" for i in n]
        # The prefix is put on before texts are cut, not to each part.
        proto = sentencepiece_model_pb2.ModelProto.FromString(m.serialized_model_proto())
        if proto.trainer_spec.model_type != proto.trainer_spec.BPE:
            raise ValueError(f"not a model of the BPE kind: {model_file}")
        prefix, proto.normalizer_spec.add_dummy_prefix = proto.normalizer_spec.add_dummy_prefix, False
        return cls([m.id_to_piece(i) for i in n], [m.get_score(i) for i in n], kinds, prefix, proto.SerializeToString())

    def __getstate__(self):
        return self.__dict__ | {"merges": None}

    def prepared(self, text: str) -> str:
        """The text as the merges see it: blanks as U+2581, one before it."""
        return (SPACE if self.prefix and text else "") + text.replace(" ", SPACE)

    def merged(self, prepared: str) -> np.ndarray:
        """The ids (32 bits each) of a prepared text or a part of one."""
        if self.merges is None:
            from sentencepiece import SentencePieceProcessor

            self.merges = SentencePieceProcessor(model_proto=self.model)
        return np.array(self.merges.encode(prepared), np.int32)

    def borders(self, text: str, a: int, b: int) -> np.ndarray:
        """Where the pieces of ``text[a:b]``, merged alone, begin and end: from ``a`` to ``b``."""
        ends = a + np.cumsum(self.width[self.merged(text[a:b])])
        if ends[-1] != b:
            raise ValueError("long texts need a model whose unknown characters become bytes and whose normaliser keeps characters")
        return np.concatenate([[a], ends[np.diff(ends, prepend=a) > 0]])

    def transfer(self, text: str, p: int, q: int) -> list[Step]:
        """The transfer matrix of the chunk ``text[p:q]`` of a prepared text, of which
        ``text`` holds ``longest`` characters more on both sides. The state at a
        border is the piece that holds the character before it; at the text's start
        it is (0, 0). The weight from state to state is 0 where the first, the pieces
        between and the second are an encoding, else minus infinity: the finite places
        are returned. For a begin of the first and an end of the second piece there
        is at most one, as ``text[a:b]`` has one encoding.

        The chunk is merged once and short windows over its borders; where a window
        shares a piece with the chunk, its split goes on as the chunk's. Where none is
        shared (runs of one character), ``text[a:b]`` is merged whole, for at most
        ``longest`` squared pairs of ends."""
        n, reach, window = len(text), self.longest, 4 * self.longest
        begins = [a for a in range(max(0, p - reach), p) if a + 1 == p or any(text[a:b] in self.id for b in range(p, min(n, a + reach) + 1))] or [0]
        ends = [b for b in range(q, min(n, q + reach - 1) + 1) if b == q or any(text[a:b] in self.id for a in range(max(0, b - reach), q))] if q < n else [n]

        def spans(at: np.ndarray) -> list[tuple[int, int]]:
            return list(zip(at[:-1].tolist(), at[1:].tolist()))

        whole = self.borders(text, p, q)
        near = {*spans(whole[: np.searchsorted(whole, p + window) + 1]), *spans(whole[max(0, np.searchsorted(whole, q - window) - 1) :])}
        heads = {a: spans(self.borders(text, a, min(p + window, q))) for a in begins}
        tails = {b: spans(self.borders(text, max(q - window, p), b)) for b in ends}
        joined = {a: min((s for s in v if s in near), default=None) for a, v in heads.items()}
        left = {b: max((s for s in v if s in near), default=None) for b, v in tails.items()}
        out = []
        for a in begins:
            for b in ends:
                if joined[a] and left[b] and joined[a] <= left[b]:
                    first, last = heads[a][0], tails[b][-1]
                else:
                    at = spans(self.borders(text, a, b))
                    first, last = at[0], at[-1]
                if p == 0:
                    first = (0, 0)
                if first[1] >= p and last[0] < q:
                    out.append((*first, *last))
        return out

    def between(self, text: str, step: Step) -> np.ndarray:
        """The ids after a step's first piece up to its second."""
        a, b, _, end = step
        ids = self.merged(text[a:end])
        return ids[a + np.cumsum(self.width[ids]) > b]

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text."""
        return self.merged(self.prepared(text))

    @property
    def decoder(self) -> Decoder:
        return Decoder(self.raw, self.prefix)

    def decode(self, ids: np.ndarray) -> str:
        return self.decoder.decode(ids)

    def score_sum(self, ids: np.ndarray) -> float:
        """Pieces of blanks, whose rank is none, count as nothing."""
        return float(self.score[ids[self.score[ids] > -1e8]].sum())
