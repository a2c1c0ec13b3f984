"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

WHITE = b"\t\n\x0b\x0c\r "


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def statistics(text: str | None) -> tuple[int, int, int, int, int]:
    w = words(text)
    triples = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = [False] * len(w)
    for i in range(len(w) - 2):
        if triples[tuple(w[i:i + 3])] > 1:
            covered[i:i + 3] = [True] * 3
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().strip(WHITE):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(len(x.decode()) for x in w), sum((text or "").count(c) for c in "#*$%&|<>"), dup, sum(covered))


def cut_repeats(docs: list[tuple[int, str | None]], size: int = 50) -> dict[int, tuple[int, int, str]]:
    owner: dict[tuple, int] = {}
    for i, text in sorted(docs):
        w = words(text)
        for k in range(len(w) - size + 1):
            owner.setdefault(tuple(w[k:k + size]), i)
    out = {}
    for i, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if owner[tuple(w[k:k + size])] < i:
                gone[k:k + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def dedup_lines(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, str]]:
    holders = defaultdict(set)
    for i, text in docs:
        for line in (text or "").encode().split(b"\n"):
            holders[line.strip(WHITE).lower()].add(i)
    out = {}
    for i, text in docs:
        lines = (text or "").encode().split(b"\n")
        kept = [x for x in lines
                if len((key := x.strip(WHITE).lower()).decode()) < 10 or min(holders[key]) == i]
        out[i] = (len(lines), len(lines) - len(kept), hashlib.sha256(b"\n".join(kept)).hexdigest())
    return out


def shingles(text: str | None, size: int = 5) -> frozenset:
    w = [x.lower() for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1)))


def components(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def find(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                a_, b_ = find(a), find(b)
                parent[max(a_, b_)] = min(a_, b_)
    return {i: (len(sets[i]), find(i)) for i in ids}


def unigram(docs: list[tuple[int, str | None]]) -> dict[int, tuple[bool, int, int, int, float]]:
    tokens = {i: [*(x.lower() for x in words(t)), None] for i, t in docs}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    counts = Counter(t for i, own in tokens.items() if not held[i] for t in own)
    n, v = sum(counts.values()), len(counts)
    return {i: (held[i], len(own), sum(counts[t] > 0 for t in own), n,
                sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)) for i, own in tokens.items()}


def chained_coverage(mine: list[str], item: list[str], size: int = 8) -> float:
    """The share of the item's windows in a longest common subsequence of windows, with those at a change of diagonal."""
    a, b = ([tuple(x[i:i + size]) for i in range(len(x) - size + 1)] for x in (mine, item))
    best: list[list[tuple]] = [[()] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = (*best[i][j], (i, j)) if x == y else max(best[i][j + 1], best[i + 1][j], key=len)
    chain = best[-1][-1]
    n = len(chain)
    for (i, j), (i2, j2) in zip(chain, chain[1:]):
        left_out = max(0, j2 - j - size)
        if i2 - i != j2 - j and left_out < size:
            n += j2 - j - 1 - left_out
    return n / len(b)


def mix_targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1.0 + i % 3 for i, s in enumerate(order)}
    total, capped = float(sum(sizes.values())), set()
    while True:
        rest = total - sum(3.0 * sizes[s] for s in capped)
        w = sum(weight[s] for s in order if s not in capped)
        target = {s: 3.0 * sizes[s] if s in capped else rest * weight[s] / w for s in order}
        over = {s for s in order if s not in capped and target[s] >= 3.0 * sizes[s]}
        if not over:
            return target
        capped |= over
        if len(capped) == len(order):
            return {s: 3.0 * sizes[s] for s in order}


def near_vectors(rows: list[tuple[int | None, list | None]], least: float = 0.95) -> list[tuple]:
    """(id, links, component, kept) of each row, every pair compared."""
    def unit(v: list | None) -> list[float] | None:
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        top = max(abs(x) for x in v)
        size = math.sqrt(math.fsum((x / top) ** 2 for x in v))
        return [x / top / size for x in v]

    units = [unit(v) if i is not None else None for i, v in rows]
    reach = list(range(len(rows)))
    links = [0] * len(rows)

    def find(i: int) -> int:
        while reach[i] != i:
            i = reach[i]
        return i

    for a, x in enumerate(units):
        for b, y in enumerate(units[:a]):
            if x and y and len(x) == len(y) and (x == y or math.fsum(p * q for p, q in zip(x, y)) >= least):
                links[a] += 1
                links[b] += 1
                reach[find(a)] = find(b)
    low: dict[int, int] = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            low[find(a)] = min(low.get(find(a), i), i)
    return [(i, links[a], low.get(find(a)), i == low.get(find(a))) for a, (i, _) in enumerate(rows)]


def periodic_runs(w: list, min_length: int = 6, repeats: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a word list, by start, then period."""
    out = []
    for q in range(1, len(w) // repeats + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if size >= max(min_length, repeats * q) and not any(
                    all(w[k] == w[k + r] for k in range(i, j + q - r)) for r in range(1, q)):
                out.append((i, size, q))
            i = max(i + 1, j)
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted_words(doc_id: int | None, text: str | None) -> list[bytes]:
    w = words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def run_row(doc_id: int | None, text: str | None) -> tuple:
    w = planted_words(doc_id, text)
    runs = periodic_runs(w)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    listing = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listing.encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


def merkle(rows: list[tuple]) -> list[tuple]:
    """(doc_id, leaf, subroot, root, proof hash, folded root, verified) of rows (doc_id, source, lang, n_chars, text)."""
    def sha(parts) -> str:
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def value(v) -> str:
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def climb(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
        """The top, and each node's siblings (left, right) by level."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for leaf, i in enumerate(at):
                low = i - i % 8
                paths[leaf].append(("".join(nodes[low:i]), "".join(nodes[i + 1:low + 8])))
            nodes = [sha(nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
            at = [i // 8 for i in at]
        return nodes[0], paths

    def small(text: str | None) -> str | None:
        return text if text is None else text.encode().lower().decode()

    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((sha(map(value, row)), row))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
    trees = {g: climb([leaf for leaf, _ in groups[g]]) for g in order}
    root, upper = climb([trees[g][0] for g in order]) if order else (None, [])
    out = []
    for no, g in enumerate(order):
        for (leaf, row), path in zip(groups[g], trees[g][1]):
            path = path + upper[no]
            now = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                now = sha(map(value, (*row[:4], small(row[4]))))
            for left, right in path:
                now = sha([left, now, right])
            out.append((row[0], leaf, trees[g][0], root, sha(a + b for a, b in path), now, now == root))
    return out
