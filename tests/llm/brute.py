"""Plain Python versions of the operators, for small fixtures."""

import hashlib
import math
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def removed_bytes(docs):
    """[(doc_id, text)] -> [(n_bytes, n_removed, n_spans, sha256)] in the same order."""
    starts = defaultdict(list)
    for i, t in docs:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            starts[b[k:k + 50]].append(math.inf if i is None else i)
    first = {w: min(x) for w, x in starts.items()}
    out = []
    for i, t in docs:
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - 49):
            if first[b[k:k + 50]] < (math.inf if i is None else i):
                gone[k:k + 50] = [True] * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, size):
    w = WORD.findall((text or "").translate(_LOWER))
    return {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def near_components(docs, size, percent):
    """[(doc_id, text)] -> {doc_id: component}."""
    sets = {i: shingles(t, size) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(i for i in sets if sets[i])
    by_shingle = defaultdict(set)
    for i in ids:
        met = set().union(*[by_shingle[s] for s in sets[i]])
        for j in met:
            common = len(sets[i] & sets[j])
            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for s in sets[i]:
            by_shingle[s].add(i)
    return {i: find(i) for i in sets}


def line_dedup(docs, words=20):
    """[(doc_id, text)] -> {doc_id: text}: pairs of successive lines, and long lines, that stood earlier go."""
    seen, out = set(), {}
    for i, t in sorted(docs):
        lines, gone = t.split("\n"), set()
        full = [k for k, x in enumerate(lines) if x.strip(" ")]
        units = sorted([(2 * a, (a, b), lines[a] + "\n" + lines[b]) for a, b in zip(full, full[1:])]
                       + [(2 * a + 1, (a,), lines[a]) for a in full if len(WORD.findall(lines[a])) >= words])
        for _, at, text in units:
            gone.update(at if text in seen else ())
            seen.add(text)
        kept, last = [], False
        for k, x in enumerate(lines):
            last = k in gone if x.strip(" ") else last
            kept += [] if last else [x]
        out[i] = "\n".join(kept)
    return out


def contaminated(docs, items, masks, span, window, share):
    """[(doc_id, text)], [(item_id, text)] -> {(doc_id, item_id): most equal words}."""
    split = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    seeds = defaultdict(list)
    words = {i: split(t) for i, t in items}
    picks = [[k for k, c in enumerate(m) if c == "1"] for m in masks]
    for i, w in words.items():
        for j in range(len(w) - span + 1):
            for m, p in enumerate(picks):
                seeds[m, tuple(w[j + k] for k in p)].append((i, j))
    found = {}
    for d, t in docs:
        w = split(t)
        for x in range(len(w) - span + 1):
            for m, p in enumerate(picks):
                for i, j in seeds.get((m, tuple(w[x + k] for k in p)), ()):
                    item = words[i]
                    n = min(len(item), window)
                    for s in range(max(j - (n - span), 0), min(j, len(item) - n) + 1):
                        equal = sum(0 <= y + x - j < len(w) and item[y] == w[y + x - j] for y in range(s, s + n))
                        if equal >= math.ceil(n * share):
                            found[d, i] = max(found.get((d, i), 0), equal)
    return found


def targets(sizes, weights=(1, 2, 3), most=3):
    """{source: size} -> {source: target}, by sharing again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, left, free = dict.fromkeys(order, 0.0), float(sum(sizes.values())), set(order)
    while left > 1e-9 and free:
        total = sum(w[s] for s in free)
        share = {s: left * w[s] / total for s in free}
        left = 0.0
        for s in list(free):
            target[s] += share[s]
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                free.discard(s)
    return target


def mix(docs, quality, seed):
    """[(doc_id, text, source)], {doc_id: weight} -> {doc_id: taken}."""
    size = {i: len(WORD.findall(t or "")) for i, t, _ in docs}
    by = defaultdict(list)
    for i, _, s in docs:
        by[s].append(i)
    sizes = {s: sum(size[i] for i in ids) for s, ids in by.items()}
    goal, out = targets(sizes), {}
    for s, ids in by.items():
        epochs = math.floor(goal[s] / sizes[s] + 1e-12) if sizes[s] else 0
        rest = goal[s] - epochs * sizes[s]
        key = {i: -math.log((int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)) / quality.get(i, 1.0) for i in ids}
        upto = 0
        for i in sorted(ids, key=lambda i: (key[i], i)):
            upto += size[i]
            out[i] = size[i] * (epochs + (rest > 1e-6 and upto - size[i] / 2 <= rest))
    return out, goal


def prefix_trie(rows):
    """[(conv_id, turn, role, text)] -> {(conv_id, depth): the other columns of a node}."""
    import zlib
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in by.items()}
    paths = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + v[h:]
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children, out = defaultdict(list), {}
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)
    sums = {}
    for prefix in sorted(members, key=len, reverse=True):
        saved = (len(members[prefix]) - 1) * (len(WORD.findall(prefix[-1][1])) if prefix else 0)
        sums[prefix] = (sum(sums[k][0] for k in children[prefix]) or 1, saved + sum(sums[k][1] for k in children[prefix]))
    for prefix, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(paths[c]) == len(prefix))
        out[min(m), len(prefix)] = (min(members[prefix[:-1]]) if prefix else None, len(m), len(children[prefix]), *sums[prefix], hashlib.sha256(ends.encode()).hexdigest())
    return out


def whitened(rows, most=16):
    """[(vec_id, vector)] -> ([(vec_id, x)], n, S, eigenvalues, eigenvectors, covariance)."""
    import numpy as np
    kept = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    sums = [sum(col) for col in zip(*fit)]
    y = np.array([[v - s / len(fit) for v, s in zip(x, sums)] for x in fit])
    cov = y.T @ y / len(fit)
    values, vectors = np.linalg.eigh(cov)
    return kept, len(fit), sums, values[::-1][:most], vectors[:, ::-1][:, :most], cov
