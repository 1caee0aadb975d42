"""BPE encoding and decoding of whole texts by prefix-sharing trie traversal.

A BPE encoding has one last token for every prefix of a word: the only token that ends there and whose
neighbour, the last token of what is before it, would not have merged with it or with a part of it. So the
encoding of a word is a chain of last tokens, and words that share a prefix share the chain. Tasks insert
the distinct words they meet into a trie, walk it depth-first and carry the last token of every prefix of
the current path; each shared prefix is worked out once. The tokens that end at a character are those of an automaton's state. The last symbol of a word is another symbol than
the same one inside (it carries the end mark), so it is looked up where a word ends and is not carried on.

Two tokens may stand side by side if undoing their merges, the later one first, never shows a pair at the
border that had been merged before (``Vocabulary.compatible``). This needs a vocabulary in which every token
comes from one merge of two earlier tokens; loading checks it.

Special tokens are cut out of the raw text first. The rest is cut at ASCII white space, where no word and no
normal form crosses; pieces of ASCII and Latin-1 letters are lowered and cut by a pattern, others go through the
normaliser and the word splitter of the vocabulary file. Codes of short pieces and words are remembered, up to MEMO of
each per worker; others are worked out again in each batch. There is no shuffle, and each text is held by one task.

Defined cases: null and empty texts have no tokens and decode to the empty text; every row gives a row,
repeated ones too; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache
from itertools import islice

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from .common import arrow_rows

VOCABULARY = "word_bpe_49k"
#: Pieces of texts and words that a worker remembers, and the longest of them.
MEMO, MEMO_CHARS = 300_000, 48
#: Characters of texts whose new words share a trie; a batch of results holds as many, or one text.
SLICE = 2 << 20
_PIECE = re.compile(r"[^ \t-\r]+")
#: Pieces of printable ASCII and of the letters of Latin-1, which are their own normal form.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
# What the vocabulary's word splitter finds in such pieces in lower case.
_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
#: How a byte-level vocabulary writes these letters: a character for each byte of their UTF-8 form, which is that of the
#: same number for 0xC3, and one of its own, from 0x100 on, for bytes that are no printable character in Latin-1.
_UNSEEN = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b)]
_WRITTEN = {
    c: "".join(chr(0x100 + _UNSEEN.index(b)) if b in _UNSEEN else chr(b) for b in chr(c).encode())
    for c in range(0xDF, 0x100) if c != 0xF7
}


class Vocabulary:
    """Tokens and merges of a vocabulary file; ids that come from no merge have rank -1."""

    def __init__(self, name: str = VOCABULARY):
        path = public_tokenizers.path(f"{name}.json")
        library = Tokenizer.from_file(path)
        self.normalise, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        model = stored["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in stored["added_tokens"]}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.text = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        size = max(self.text) + 1
        self.sizes = [len(self.text.get(t, "")) for t in range(size)]
        self.rank, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.pairs: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = (self.ids[part] for part in (merge if isinstance(merge, list) else merge.split(" ")))
            made = self.ids[self.text[a] + self.text[b]]
            if self.rank[made] >= 0 or not max(self.rank[a], self.rank[b]) < rank:
                raise ValueError(f"{name}: token {made} is not one merge of earlier tokens")
            self.rank[made], self.left[made], self.right[made] = rank, a, b
            self.pairs[a, b] = rank
        # A token can end a prefix only if its own text is encoded as this one token.
        own = {-1: True}
        for t in sorted(self.ids.values(), key=self.rank.__getitem__):
            a, b = self.left[t], self.right[t]
            own[t] = own[a] and own[b] and (a < 0 or self._apart(a, b, self.rank[t]))
        self.own = {t for t in self.ids.values() if own[t]}
        self._connect()
        self.compatible = lru_cache(1 << 18)(lambda a, b: self._apart(a, b, len(self.pairs)))

    def _connect(self) -> None:
        """The beginnings of tokens as states: ``steps`` leads from a state by a character to the next, ``shorter`` to the state
        of the longest proper ending. ``inner`` and ``closing`` have the (token, characters) that end in a state inside
        and at the end of a word, the longest first.
        """
        self.steps, self.shorter = [{}], [0]
        inside: dict[int, int] = {}
        at_end: dict[int, int] = {}
        for t in self.own:
            token = self.text[t]
            ends = bool(self.end) and token.endswith(self.end) and token != self.end
            state = 0
            for character in token.removesuffix(self.end) if ends else token:
                further = self.steps[state].get(character)
                if further is None:
                    further = self.steps[state][character] = len(self.steps)
                    self.steps.append({})
                    self.shorter.append(0)
                state = further
            (at_end if ends else inside)[state] = t
        self.inner = [()] * len(self.steps)
        self.closing = [()] * len(self.steps) if self.end else self.inner
        level, size = [0], 0
        while level:
            size += 1
            following = []
            for state in level:
                for character, further in self.steps[state].items():
                    ending = self._step(self.shorter[state], character) if state else 0
                    self.shorter[further] = ending
                    self.inner[further] = self.inner[ending]
                    if further in inside:
                        self.inner[further] = ((inside[further], size), *self.inner[ending])
                    if self.end:
                        self.closing[further] = self.closing[ending]
                        if further in at_end:
                            self.closing[further] = ((at_end[further], size), *self.closing[ending])
                    following.append(further)
            level = following

    def _step(self, state: int, character: str) -> int:
        """The state of the longest beginning of a token that ends with this character."""
        while (further := self.steps[state].get(character)) is None and state:
            state = self.shorter[state]
        return further or 0

    def _apart(self, a: int, b: int, before: int) -> bool:
        """Whether no pair at the border of a and b is merged before the merge of rank ``before``."""
        rank, pairs = self.rank, self.pairs
        while True:
            if pairs.get((a, b), before) < before:
                return False
            if rank[a] > rank[b]:
                before, a = rank[a], self.right[a]
            elif rank[b] >= 0:
                # Of equal merges the left one comes first, so a pair at the border comes before that of b.
                before, b = rank[b] + 1, self.left[b]
            else:
                return True

    def ids_of(self, words: set[str]) -> dict[str, bytes]:
        return encode_trie(Trie(words), self)


class Trie:
    """Words as labelled edges: a node is (is a word, {first character: (label, node)})."""

    def __init__(self, words):
        self.root = [False, {}]
        for word in words:
            self.insert(word)

    def insert(self, word: str) -> None:
        node, at = self.root, 0
        while at < len(word):
            label, child = node[1].get(word[at], ("", None))
            if child is None:
                node[1][word[at]] = (word[at:], [True, {}])
                return
            if not word.startswith(label, at):
                same = next(k for k in range(len(label)) if at + k >= len(word) or label[k] != word[at + k])
                child = [False, {label[same]: (label[same:], child)}]
                node[1][word[at]] = (label[:same], child)
                label = label[:same]
            node, at = child, at + len(label)
        node[0] = True


def encode_trie(trie: Trie, vocabulary: Vocabulary) -> dict[str, bytes]:
    """The ids of every word of the trie, as little-endian unsigned 32-bit numbers."""
    compatible, steps, shorter = vocabulary.compatible, vocabulary.steps, vocabulary.shorter
    inner, closing, sizes, end = vocabulary.inner, vocabulary.closing, vocabulary.sizes, len(vocabulary.end)
    last: list[int] = [-1]  # last[k]: the last token of the first k characters of the path
    path, found = "", {}
    # With each edge: the state at its start.
    todo = [(0, "", trie.root, 0)]
    while todo:
        depth, label, (is_word, children), state = todo.pop()
        path = path[:depth] + label
        del last[depth + 1 :]
        length = len(path)
        for at, character in enumerate(label, depth + 1):
            further = steps[state].get(character)
            while further is None and state:
                state = shorter[state]
                further = steps[state].get(character)
            state = further or 0
            if children or at < length:
                for token, size in inner[state]:
                    if size == at or compatible(last[at - size], token):
                        last.append(token)
                        break
                else:
                    raise ValueError(f"no token ends {path[:at]!r}")
        if is_word:
            for token, size in closing[state]:
                if size == length or compatible(last[length - size], token):
                    break
            else:
                raise ValueError(f"no token closes {path!r}")
            ids, at = [token], length + end - sizes[token]
            while at > 0:
                token = last[at]
                ids.append(token)
                at -= sizes[token]
            ids.reverse()
            found[path] = array("I", ids).tobytes()
        if children:
            todo += [(length, edge, child, state) for edge, child in children.values()]
    return found


class Coder:
    """Encodes and decodes texts; one per Python worker."""

    def __init__(self, vocabulary: str = VOCABULARY):
        self.vocabulary = Vocabulary(vocabulary)
        self.special = {t: array("I", [i]).tobytes() for t, i in self.vocabulary.special.items()}
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _cut(self, piece: str) -> list[str]:
        """The words of a piece, as the vocabulary writes their bytes."""
        if _PLAIN.fullmatch(piece):
            lower = piece.lower()
            return _WORD.findall(lower) if lower.isascii() else [w.translate(_WRITTEN) for w in _WORD.findall(lower)]
        return [word for word, _ in self.vocabulary.split(self.vocabulary.normalise(piece))]

    def _parts(self, text: str) -> list[str]:
        """Pieces without special tokens, and special tokens, which are always whole items."""
        if not any(token in text for token in self.special):
            return _PIECE.findall(text)
        cut = enumerate(self.vocabulary.special_pattern.split(text))
        return [item for k, part in cut for item in ([part] if k % 2 else _PIECE.findall(part))]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit numbers; all new words go through one trie."""
        parts = [self._parts(text or "") for text in texts]
        new = {piece: self._cut(piece) for piece in set().union(*parts).difference(self.pieces, self.special)}
        fresh = self.vocabulary.ids_of({word for cut in new.values() for word in cut}.difference(self.words))
        # Those beyond the memos are in them for this batch only.
        self.words |= fresh
        coded = {piece: b"".join(map(self.words.__getitem__, cut)) for piece, cut in new.items()}
        coded |= self.special
        self.pieces |= coded
        out = [b"".join(map(self.pieces.__getitem__, part)) for part in parts]
        for memo, found in ((self.pieces, coded), (self.words, fresh)):
            short = (item for item in found if len(item) <= MEMO_CHARS and item not in self.special)
            for item in found.keys() - islice(short, MEMO + len(found) - len(memo)):
                del memo[item]
        return out

    def decode(self, ids: bytes) -> str:
        """The tokens' texts, one space between them: the vocabulary file names no decoder."""
        return " ".join(map(self.vocabulary.text.__getitem__, array("I", ids)))


@lru_cache(maxsize=2)
def coder(vocabulary: str = VOCABULARY) -> Coder:
    return Coder(vocabulary)


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids as little-endian unsigned 32-bit numbers, decoded: the text decoded from them)."""

    id_type = to_arrow_type(docs.schema["doc_id"].dataType)

    def coded(keys, texts):
        worker = coder(vocabulary)
        ids = worker.encode(texts)
        columns = [pa.array(keys, id_type), pa.array(ids, pa.binary()), pa.array(map(worker.decode, ids), pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    def code(batches):
        for batch in batches:
            keys, texts, size = [], [], 0
            for doc_id, text in arrow_rows(batch, "doc_id", "text"):
                keys.append(doc_id)
                texts.append(text)
                size += len(text or "")
                if size >= SLICE:
                    yield coded(keys, texts)
                    keys, texts, size = [], [], 0
            if keys:
                yield coded(keys, texts)

    out = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary, decoded string"
    return docs.select("doc_id", "text").mapInArrow(code, out)


def digest(coded: DataFrame) -> DataFrame:
    return coded.select(
        "doc_id",
        F.floor(F.length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
