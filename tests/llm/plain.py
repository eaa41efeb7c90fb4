"""The operators' results worked out row by row, to compare with."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256
from math import log10

import numpy as np
import xxhash

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text: str | bytes) -> str:
    return sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def token_ids(texts: list[str], end: int) -> list[np.ndarray]:
    from tokenizers import Tokenizer

    from totelane.llm.tokens import word_bpe

    tokenizer = Tokenizer.from_file(word_bpe())
    found = tokenizer.encode_batch(texts, add_special_tokens=False)
    return [np.array([*x.ids, end], "<u4") for x in found]


def fingerprint(text: str) -> int:
    words = text.translate(_LOWER).encode().split()
    if not words:
        return 0
    size = min(3, len(words))
    runs = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
    hashes = [xxhash.xxh64_intdigest(run, 42) for run in runs]
    return sum(
        1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
    )


def near_groups(texts: list[str]) -> list[int]:
    """The smallest place reachable over fingerprints three bits apart."""
    prints = [fingerprint(x) for x in texts]
    group = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if group[j] < group[i] and (a ^ b).bit_count() <= 3:
                    group[i], changed = group[j], True
    return group


def words(text: str) -> list[str]:
    return _WORDS.findall(text.translate(_LOWER))


def contamination(texts: list[str], items: list[tuple]) -> list[tuple]:
    windows = defaultdict(set)
    for item_id, text in items:
        own = words(text or "")
        size = min(10, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            windows[tuple(own[i : i + size])].add(item_id)
    found = []
    for text in texts:
        own, hit, named = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(own) - size + 1):
                if (run := tuple(own[i : i + size])) in windows:
                    hit.update(range(i, i + size))
                    named |= {str(x) for x in windows[run] if x is not None}
        listed = sha(",".join(sorted(named)))
        found.append((len(own), len(hit), len(named), listed, bool(hit)))
    return found


def repeats(rows: list[tuple]) -> list[tuple]:
    least: dict[tuple, float] = {}
    rank = [float("inf") if doc_id is None else doc_id for doc_id, _ in rows]
    split = [text.encode().split() for _, text in rows]
    for own, place in zip(split, rank, strict=True):
        for i in range(len(own) - 12):
            run = tuple(own[i : i + 13])
            least[run] = min(place, least.get(run, float("inf")))
    found = []
    for own, place in zip(split, rank, strict=True):
        gone = {
            i + k
            for i in range(len(own) - 12)
            if least[tuple(own[i : i + 13])] < place
            for k in range(13)
        }
        kept = [word for i, word in enumerate(own) if i not in gone]
        found.append((len(own), len(gone), sha(b" ".join(kept))))
    return found


def base_scores(rows: list[tuple]) -> list[tuple]:
    counts: Counter = Counter()
    parts = []
    for doc_id, text in rows:
        key = b"" if doc_id is None else str(doc_id).encode()
        held = zlib.crc32(key) % 5 == 1
        own = [*text.translate(_LOWER).encode().split(), "end"]
        parts.append((held, own))
        if not held:
            counts.update(own)
    n, v = sum(counts.values()), len(counts)
    return [
        (
            held,
            len(own),
            sum(counts[w] > 0 for w in own),
            n,
            sum(log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own),
        )
        for held, own in parts
    ]


def phrase_places(text: str) -> tuple[list[int], str]:
    own, places, labels = words(text), [], set()
    for phrase, label in (
        ("mit license", "mit"),
        ("apache license", "apache"),
        ("general public license", "gpl"),
    ):
        part = phrase.split()
        for i in range(len(own)):
            if own[i : i + len(part)] == part:
                places.append(i)
                labels.add(label)
    return sorted(places), ",".join(sorted(labels))


def near(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point parts two words."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(
        long[:i] + long[i + 1 :] == short for i in range(len(long))
    )


def spelling(rows: list[tuple]) -> list[tuple]:
    counts: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            run = run.translate(_LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    often = {word: n for word, n in counts.items() if len(word) >= 7 and n >= 2}
    by_size = defaultdict(list)
    for word in often:
        by_size[len(word)].append(word)
    form, partners = {}, {}
    for word, n in often.items():
        around = [x for d in (-1, 0, 1) for x in by_size[len(word) + d] if near(word, x)]
        partners[word] = len(around)
        best = min(around, key=lambda x: (-often[x], x), default=None)
        form[word] = best if best is not None and often[best] >= 10 * n else None
    found = []
    for word, n in often.items():
        root = word
        while form[root] is not None:
            root = form[root]
        found.append((word, form[word], root, n, partners[word], often.get(form[word])))
    return found


def _hash(*parts: str) -> str:
    return sha("".join(parts))


def manifest(rows: list[tuple], tampered) -> list[tuple]:
    """Rows of doc_id, source, lang, n_chars, text; ``tampered`` says which text to lower."""

    def leaf(row: tuple) -> str:
        texts = [None if x is None else str(x) for x in row]
        return _hash(*("-" if x is None else f"{len(x.encode())}:{x}" for x in texts))

    def climb(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
        """The last node, and for each first node what stands beside it on every level."""
        beside, place = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, own in enumerate(place):
                run = nodes[own // 8 * 8 : own // 8 * 8 + 8]
                beside[i].append(("".join(run[: own % 8]), "".join(run[own % 8 + 1 :])))
            place = [own // 8 for own in place]
            nodes = [_hash(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        return nodes[0], beside

    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append(row)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted(groups[lang], key=lambda x: (x[0] is not None, x[0] or 0, leaf(x)))
        trees[lang] = (own, *climb([leaf(x) for x in own]))
    if not langs:
        return []
    root, tops = climb([trees[lang][1] for lang in langs])
    found = []
    for lang, top in zip(langs, tops, strict=True):
        own, subroot, beside = trees[lang]
        for row, path in zip(own, beside, strict=True):
            path = path + top
            folded = leaf(row)
            if tampered(row) and row[4] is not None:
                folded = leaf((*row[:4], row[4].translate(_LOWER)))
            for left, right in path:
                folded = _hash(left, folded, right)
            proof = _hash(*(x + y for x, y in path))
            found.append((row[0], leaf(row), subroot, root, proof, folded, folded == root))
    return found


def archives(pages: list[tuple]) -> list[tuple]:
    import base64
    from hashlib import sha1

    groups = defaultdict(list)
    for page_id, _, html in pages:
        groups[html or ""].append(page_id)
    found = []
    for html, ids in groups.items():
        ids.sort(key=lambda x: (x is None, x or 0))
        digest = base64.b32encode(sha1(html.encode()).digest()).decode()
        for i, page_id in enumerate(ids):
            kind, source = ("revisit", ids[0]) if i else ("response", None)
            found.append((page_id, len(html.encode()), digest, kind, source))
    return found


class ContextTrees:
    """Weighted trees over byte contexts, straight from the definition."""

    def __init__(self, texts: list[bytes], depth: int):
        self._depth = depth
        self._counts: Counter = Counter()
        for context, byte in (x for text in texts for x in self.places(text)):
            self._counts.update((*node, bit) for node, bit in self._bits(context, byte))

    def places(self, text: bytes) -> list[tuple[bytes, int]]:
        """Context and byte of each byte of a text and of the end after its words."""
        whole = b"\n" * self._depth + b" ".join(text.lower().split()) + b"\n"
        return [(whole[i - self._depth : i], whole[i]) for i in range(self._depth, len(whole))]

    def _bits(self, context: bytes, byte: int):
        node = 1
        for place in range(7, -1, -1):
            bit = byte >> place & 1
            for length in range(self._depth + 1):
                yield (context[self._depth - length :], node), bit
            node = node * 2 + bit

    def _weighted(self, context: bytes, node: int, extra: tuple | None) -> float:
        """Probability of the bits at a node in a context, one more on the path of ``extra``."""
        from math import gamma, pi

        on_path = extra is not None and extra[0].endswith(context)
        own = [
            self._counts[context, node, bit] + (on_path and extra[1] == bit) for bit in (0, 1)
        ]
        estimate = gamma(own[0] + 0.5) * gamma(own[1] + 0.5) / gamma(sum(own) + 1) / pi
        if len(context) == self._depth:
            return estimate
        longer = 1.0
        for byte in {c[-len(context) - 1] for c in self._seen(context, node, extra)}:
            longer *= self._weighted(bytes([byte]) + context, node, extra)
        return (estimate + longer) / 2

    def _seen(self, context: bytes, node: int, extra: tuple | None) -> set:
        seen = {
            c for c, n, _ in self._counts if n == node and len(c) == self._depth and c.endswith(context)
        }
        return seen | ({extra[0]} if extra and extra[0].endswith(context) else set())

    def log10(self, context: bytes, byte: int) -> float:
        total, node = 0.0, 1
        for place in range(7, -1, -1):
            bit = byte >> place & 1
            after = self._weighted(b"", node, (context, bit))
            total += log10(after / self._weighted(b"", node, None))
            node = node * 2 + bit
        return total
