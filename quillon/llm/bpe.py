"""BPE encoding and decoding with a tokenization automaton.

The automaton reads tokens. It starts as one state that allows every base symbol and is changed by
one merge gadget for each merge (u, v) -> uv, in order: every arc u leads to a copy of its target
from which the arc v is taken out, and every state with an arc u gets an arc uv to the target of v.
The result is deterministic, the target of an arc depends on its label alone, and a token sequence
is the tokenization of its string exactly if the automaton accepts it. A copy keeps its parent and
the time of copying instead of all its arcs, so the table has one entry for each merge.
A full transition table would have an entry for nearly every pair of tokens; whether an arc is there
follows from the table by at most as many look-ups as a token has parts, and what was asked is kept in a
bounded table of its own. A pre-split word, whole tokens included, is encoded left to right by transitions
alone: each prefix has one last token whose arc leaves the state of the prefix before it. Decoding emits
the arc labels of the ids.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm._ship import ship

#: Words whose encoding, and transitions whose presence, a task remembers before it starts over.
CACHE_WORDS, TRANSITIONS = 200_000, 2_000_000

_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"


# The settings of a tokenizer file that this one reads.
_SETTINGS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "decoder": None,
    "model.type": "BPE",
}
_UNUSED = ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")


def _setting(spec: dict, name: str):
    for part in name.split("."):
        spec = spec[part]
    return spec


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {b: chr(b) for b in plain}
    shown |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
    return [shown[b] for b in range(256)]


class Automaton:
    """The compiled automaton of a vocabulary and its merges."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.vocab, self.suffix = vocab, suffix
        n = max(vocab.values(), default=0) + 1
        self.left = [-1] * n
        self.made = [0] * n
        self.state = [0] * n  # target of the arc with this label
        self.parent, self.copied, self.cut = [-1], [0], [{}]  # of each state; cut: label -> time
        users = [n]  # labels whose arcs lead to the state
        for time, (x, y) in enumerate(merges, 1):
            u, v, w = vocab[x], vocab[y], vocab[x + y]
            if not self._allowed(self.state[u], v):
                continue
            target = self.state[v]
            p = self.state[u]
            if users[p] > 1 or p == target:  # a copy for u alone; uv keeps the old target
                users[p] -= 1
                self.parent.append(p)
                self.copied.append(time)
                self.cut.append({})
                users.append(1)
                p = self.state[u] = len(users) - 1
            self.cut[p][v] = time
            users[self.state[w]] -= 1
            self.state[w] = target
            users[target] += 1
            self.left[w], self.made[w] = u, time
        self._arcs: dict[int, bool] = {}
        self._root: dict | None = None

    def __getstate__(self):
        return self.__dict__ | {"_arcs": {}, "_root": None}

    def _removed(self, state: int, label: int) -> float:
        """When the arc was taken out of the state, or infinity."""
        before = float("inf")
        while state >= 0:
            t = self.cut[state].get(label)
            if t is not None and t < before:
                return t
            before = min(before, self.copied[state])
            state = self.parent[state]
        return float("inf")

    def _allowed(self, state: int, label: int) -> bool:
        """Whether the state has the arc: an arc comes with its left part's arc if that was there."""
        limit = float("inf")
        while label >= 0:
            t = self._removed(state, label)
            if t < float("inf") and t <= limit:
                return False
            limit = self.made[label]
            label = self.left[label]
        return True

    def _labels_by_prefix(self) -> dict:
        """The labels as nested tables by symbol; "" holds the label that ends there, a suffix is one symbol."""
        root: dict = {}
        for t, i in self.vocab.items():
            node = root
            for c in t.removesuffix(self.suffix) if self.suffix else t:
                node = node.setdefault(c, {})
            node[self.suffix if self.suffix and t.endswith(self.suffix) else ""] = i
        return root

    def encode_symbols(self, word: str) -> list[int]:
        """Ids of one word of byte symbols, whose last symbol carries the suffix."""
        n, suffix = len(word), self.suffix
        if self._root is None:
            self._root = self._labels_by_prefix()
        root, arcs, state = self._root, self._arcs, self.state
        if len(arcs) > TRANSITIONS:
            arcs.clear()
        # A prefix has one tokenization, so a prefix that was reached once and led nowhere is dead.
        dead: set[int] = set()
        ids: list[int] = []
        open_: list[tuple[int, list[tuple[int, int]]]] = []  # prefixes on the path and their ends not tried yet
        at = 0
        while True:
            node, found, i = root, [], at
            while i < n:
                node = node.get(word[i])
                if node is None:
                    break
                i += 1
                t = node.get(suffix if i == n else "")
                if t is not None:
                    found.append((t, i))
            while True:
                base = state[ids[-1]] << 32 if ids else -1
                while found:
                    t, end = found.pop()
                    if end in dead:
                        continue
                    if base >= 0:
                        ok = arcs.get(base | t)
                        if ok is None:
                            ok = arcs[base | t] = self._allowed(base >> 32, t)
                        if not ok:
                            continue
                    break
                else:
                    dead.add(at)
                    ids.pop()
                    at, found = open_.pop()
                    continue
                break
            ids.append(t)
            if end == n:
                return ids
            open_.append((at, found))
            at = end


class Tokenizer:
    """Encodes and decodes like a byte-level BPE tokenizer file with word-end suffixes and NFC lower-casing.

    A file that asks for anything else is refused.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if wrong := [k for k, v in _SETTINGS.items() if v != _setting(spec, k)] + [k for k in _UNUSED if model.get(k)]:
            raise ValueError(f"{path}: settings that this tokenizer doesn't have: {wrong}")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens that match otherwise than as they are")
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels: dict[int, str] = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        self._bytes = _byte_symbols()
        self._compile()

    def _compile(self) -> None:
        self._find = regex.compile(_SPLIT).findall
        self._cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self._seen: dict[str, bytes] = {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("_find", "_cut", "_seen")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._compile()

    def _plain(self, text: str) -> list[bytes]:
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = text.lower() if "Σ" not in text else "".join(c.lower() for c in text)
        seen, out = self._seen, []
        for w in self._find(text):
            ids = seen.get(w)
            if ids is None:
                if len(seen) >= CACHE_WORDS:
                    seen.clear()
                symbols = w if w.isascii() and " " not in w and w.isprintable() else "".join([self._bytes[b] for b in w.encode()])
                ids = b"".join([i.to_bytes(4, "little") for i in self.automaton.encode_symbols(symbols)])
                seen[w] = ids
            out.append(ids)
        return out

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self._cut is None or not any(s in text for s in self.special):
            return b"".join(self._plain(text))
        out: list[bytes] = []
        for part in self._cut.split(text):
            out.extend([self.special[part].to_bytes(4, "little")] if part in self.special else self._plain(part))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The labels of the ids, joined as the file's missing decoder joins them."""
        return " ".join(map(self.labels.__getitem__, memoryview(ids).cast("I")))


def encode_documents(spark: SparkSession, docs: DataFrame, path: str, column: str = "text") -> DataFrame:
    """docs(doc_id, text, ...) -> (doc_id, ids array<int>, decoded string), whole texts.

    A null text counts as empty: no ids and an empty decoded text. Other columns are ignored, so
    their names can't clash. Rows that repeat come back as often as they stand. The strings of
    special tokens in a text give their ids. The broadcast automaton's size is set by the file.
    """
    ship(spark)
    shared = spark.sparkContext.broadcast(Tokenizer(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ids = [tok.encode(t or "") for t in texts]
            offsets, n = [0], 0
            for x in ids:
                n += len(x) // 4
                offsets.append(n)
            flat = pa.Array.from_buffers(pa.int32(), n, [None, pa.py_buffer(b"".join(ids))])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat), pa.array([tok.decode(x) for x in ids], pa.string())], names=["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def encode_digests(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) by the same automaton, without moving ids to the JVM.

    Cases as in encode_documents.
    """
    ship(spark)
    shared = spark.sparkContext.broadcast(Tokenizer(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = shared.value
        for batch in batches:
            n, a, b = [], [], []
            for t in batch.column("text"):
                ids = tok.encode(t.as_py() or "")
                n.append(len(ids) // 4)
                a.append(hashlib.sha256(ids).hexdigest())
                b.append(hashlib.sha256(tok.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
