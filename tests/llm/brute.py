"""Plain single-process versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import xxhash

WORD = re.compile("[^\x20\x09-\x0D]+")
TEST_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def before(a, b) -> bool:
    """(doc_id, place) earlier, None first."""
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    return key(a) < key(b)


def repeated(rows, size):
    """Per row, the flags of the items covered by a window that also starts earlier.

    ``rows`` is a list of (id, items)."""
    first = {}
    for doc, items in rows:
        for p in range(len(items) - size + 1):
            key = tuple(items[p:p + size])
            if key not in first or before((doc, p), first[key]):
                first[key] = (doc, p)
    out = []
    for doc, items in rows:
        gone = [False] * len(items)
        for p in range(len(items) - size + 1):
            if before(first[tuple(items[p:p + size])], (doc, p)):
                gone[p:p + size] = [True] * size
        out.append(gone)
    return out


def substring_dedup(rows, size=20):
    """[(id, n_words, n_removed, kept)] from [(id, text)]."""
    flags = repeated([(i, words(t)) for i, t in rows], size)
    return [(i, len(f), sum(f), " ".join(w for w, g in zip(words(t), f) if not g))
            for (i, t), f in zip(rows, flags)]


def line_dedup(rows, size=3, long_words=None):
    """[(id, text, n_lines, n_removed)] from [(id, text)]."""
    solid = [[(k, x) for k, x in enumerate((t or "").split("\n")) if WORD.search(x)]
             for _, t in rows]
    flags = repeated([(i, [x for _, x in s]) for (i, _), s in zip(rows, solid)], size)
    long = [[x if long_words is not None and len(words(x)) > long_words else None for _, x in s]
            for s in solid]
    first: dict = {}
    for (i, _), s in zip(rows, long):
        for k, x in enumerate(s):
            if x is not None and (x not in first or before((i, k), first[x])):
                first[x] = (i, k)
    out = []
    for (i, t), s, f, o in zip(rows, solid, flags, long):
        gone = {k for p, ((k, _), g, x) in enumerate(zip(s, f, o))
                if g or (x is not None and before(first[x], (i, p)))}
        lines = t.split("\n") if t is not None else []
        kept = "\n".join(x for k, x in enumerate(lines) if k not in gone)
        out.append((i, None if t is None else kept, len(lines), len(gone)))
    return out


def trigram_cells(text, bits=16):
    """Cells of the trigrams of lower-cased letters, anything else one blank between."""
    out, letters = [], [32]
    for c in text.lower():
        point = ord(c) if c.isalpha() else 32
        if point != 32 or letters[-1] != 32:
            letters.append(point)
    letters += [32] if letters[-1] != 32 else []
    if len(letters) < 3:
        return []
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        h = (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) % 2 ** 32
        h = (h ^ (h >> 15)) * 0x85EBCA77 % 2 ** 32
        out.append(h >> (32 - bits))
    return out


def language_mixture(rows, texts, smoothing=0.5, penalty=3.0, least=0.02, cells=1 << 16):
    """[(language, score, set)] of ``texts`` by plain expectation-maximisation; ``rows`` are the
    (lang, text) to learn from."""
    counts: dict = {}
    for name, text in rows:
        if name is not None and text is not None:
            counts.setdefault(name, Counter()).update(trigram_cells(text))
    counts = {n: c for n, c in counts.items() if c}
    names = sorted(counts)
    total = {n: sum(counts[n].values()) + smoothing * cells for n in names}
    like = lambda n, cell: (counts[n][cell] + smoothing) / total[n]

    def fit(some, found):
        share = {n: 1 / len(some) for n in some}
        size = sum(found.values())
        for _ in range(40 if len(some) > 1 else 0):
            new = dict.fromkeys(some, 0.0)
            for cell, k in found.items():
                each = {n: share[n] * like(n, cell) for n in some}
                for n in some:
                    new[n] += k * each[n] / sum(each.values()) / size
            moved = max(abs(new[n] - share[n]) for n in some)
            share = new
            if moved < 1e-4:
                break
        return share, sum(k * math.log(sum(share[n] * like(n, cell) for n in some))
                          for cell, k in found.items())

    out = []
    for text in texts:
        found = Counter(trigram_cells(text or ""))
        if not found or not names:
            out.append(("und", 0.0, ()))
            continue
        share, _ = fit(names, found)
        order = sorted(names, key=lambda n: -share[n])
        chosen, (best, reached) = order[:1], fit(order[:1], found)
        for size in range(2, sum(s >= least for s in share.values()) + 1):
            part, value = fit(order[:size], found)
            if value - reached <= penalty * math.log(sum(found.values()) + 1):
                break
            chosen, best, reached = order[:size], part, value
        chosen = sorted(chosen, key=lambda n: -best[n])
        out.append((chosen[0], best[chosen[0]], tuple(chosen)))
    return out


def shingles(text, size):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + size]) for k in range(len(w) - size + 1)) if len(w) >= size \
        else frozenset([tuple(w)] if w else [])


def near_dedup(rows, size, percent=80):
    """[(id, set size, component)] from [(id, text)], all pairs compared."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    holders: dict = {}
    for a, s in enumerate(sets):
        common = Counter(b for g in s for b in holders.get(g, ()))
        for b, both in common.items():
            if 100 * both >= percent * (len(s) + len(sets[b]) - both):
                root[find(a)] = find(b)
        for g in s:
            holders.setdefault(g, []).append(a)
    least: dict = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return [(i, len(s), least.get(find(a)) if s else i)
            for a, ((i, _), s) in enumerate(zip(rows, sets))]


def windows(items, size=10):
    found: dict = {}
    for item, text in items:
        w = TEST_WORD.findall((text or "").translate(LOWER))
        for p in range(max(1, len(w) - size + 1) if w else 0):
            found.setdefault(tuple(w[p:p + size]), set()).add("" if item is None else str(item))
    return found


def decontaminate(rows, items, size=10):
    """[(id, n_words, n_hit, items)]."""
    found = windows(items, size)
    out = []
    for i, t in rows:
        w = TEST_WORD.findall((t or "").translate(LOWER))
        hit, named = [False] * len(w), set()
        for length in {len(k) for k in found}:
            for p in range(len(w) - length + 1):
                if names := found.get(tuple(w[p:p + length])):
                    named |= names
                    hit[p:p + length] = [True] * length
        out.append((i, len(w), sum(hit), sorted(named)))
    return out


def targets(sizes: dict, limit=3):
    """Water filling by repeated sharing: {source: target}."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left, shares = total - sum(fixed.values()), sum(weight[s] for s in free)
        goal = {s: left * weight[s] / shares for s in free}
        over = [s for s in free if goal[s] > limit * sizes[s]]
        if not over:
            return {**fixed, **goal}
        fixed |= {s: float(limit * sizes[s]) for s in over}


def url_rule(url, rules):
    """(host, path, rule, verdict)."""
    found = re.search("://([^/?#]*)([^?#]*)", url or "")
    host, path = (found[1].translate(LOWER), found[2]) if found else ("", "")
    best = (None, None)
    for verdict, rule in rules:
        name, slash, rest = rule.partition("/")
        if ((host == name or host.endswith("." + name)) and path.startswith(slash + rest)
                and len(rule) > len(best[0] or "")):
            best = (rule, verdict)
    return (host, path, *best)


def _field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def _nodes(digests, fanout=8):
    """Levels of a tree: the leaves first, one node last."""
    levels = [digests]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([sha("".join(x[i:i + fanout])) for i in range(0, len(x), fanout)])
    return levels


def _beside(levels, i, fanout=8):
    out = []
    for x in levels[:-1]:
        s = i // fanout * fanout
        out.append(("".join(x[s:i]), "".join(x[i + 1:s + fanout])))
        i //= fanout
    return out


def merkle(rows, tamper):
    """[(id, leaf, subroot, root, proof, folded, verified)] of (id, source, lang, n, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r, sha("".join(map(_field, r)))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in names:
        groups[g].sort(key=lambda rl: (rl[0][0] is not None, rl[0][0] or 0, rl[1]))
        trees.append(_nodes([leaf for _, leaf in groups[g]]))
    top = _nodes([t[-1][0] for t in trees])
    out = []
    for k, g in enumerate(names):
        for i, (r, leaf) in enumerate(groups[g]):
            path = _beside(trees[k], i) + _beside(top, k)
            folded = sha("".join(map(_field, tamper(r))))
            for a, b in path:
                folded = sha(a + folded + b)
            out.append((r[0], leaf, trees[k][-1][0], top[-1][0],
                        sha("".join(a + b for a, b in path)), folded, folded == top[-1][0]))
    return out


def hard_negatives(rows, positives=5, negatives=3):
    """{(anchor, positive, rank, negative, scores)} of (id, whole vector, label), all distinct."""
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    name = lambda r: (r[0] is None, r[0] or 0)
    out = set()
    for a in rows:
        if a[0] is None or a[0] % 50:
            continue
        held = lambda x: max(-2 ** 63 + 1, min(2 ** 63 - 1, x))
        scored = sorted(((-held(dot(a[1], r[1])), *name(r), r) for r in rows), key=lambda x: x[:3])
        same = [(r, -s) for s, _, _, r in scored if r[2] == a[2] and r[0] != a[0]][:positives]
        for p, ps in same:
            near = [(r, -s) for s, _, _, r in scored
                    if r[2] != a[2] and 50 * ps <= 100 * -s <= 95 * ps][:negatives]
            out |= {(a[0], p[0], k + 1, r[0], ps, s) for k, (r, s) in enumerate(near)}
    return out


def url_scores(urls, rules, order=5, symbols=94 - 26 + 2):
    """({url: score}, threshold) by Witten-Bell models of the URLs that a rule decides."""
    def marked(url):
        body = re.sub(r"[^\x21-\x7E]", "\x01", re.sub("^[^:/?#]*://", "", url).lower())
        return "\x02" * order + body + "\x03"

    half = lambda u: xxhash.xxh64_intdigest(u.encode(), 42) & 1
    counts: dict = {}
    decided = {u: url_rule(u, rules)[3] for u in set(urls) if u}
    for u, verdict in decided.items():
        for f in ((half(u), None) if verdict else ()):
            t = marked(u)
            for i in range(order, len(t)):
                for k in range(order + 1):
                    counts.setdefault((verdict, f, t[i - k:i]), Counter())[t[i]] += 1

    def log(verdict, f, t, i):
        p = 1 / symbols
        for k in range(order + 1):
            c = counts.get((verdict, f, t[i - k:i]))
            if c:
                p = (c[t[i]] + len(c) * p) / (sum(c.values()) + len(c))
        return math.log(p)

    def score(u, f):
        t = marked(u)
        each = [log("allow", f, t, i) - log("block", f, t, i) for i in range(order, len(t))]
        return sum(each) / len(each)

    own = {v: [score(u, 1 - half(u)) for u, x in decided.items() if x == v] for v in ("allow", "block")}
    if not own["allow"] or not own["block"]:
        return {u: score(u, None) for u in decided}, None
    mean = {v: sum(x) / len(x) for v, x in own.items()}
    dev = {v: math.sqrt(sum((y - mean[v]) ** 2 for y in x) / len(x)) for v, x in own.items()}
    a, b = "allow", "block"
    limit = ((mean[a] + mean[b]) / 2 if dev[a] + dev[b] == 0
             else (mean[a] * dev[b] + mean[b] * dev[a]) / (dev[a] + dev[b]))
    return {u: score(u, None) for u in decided}, limit
