"""Plain-Python versions of the operators, for small tables."""

import hashlib
import re

SPACE = re.compile("[\x20\x09-\x0d]+")


def words(text, lower=True):
    text = text or ""
    if lower:
        text = text.translate({c: c + 32 for c in range(65, 91)})
    return [w for w in SPACE.split(text) if w]


def shingles(text, size):
    w = words(text)
    if not w:
        return frozenset()
    if len(w) < size:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def near_duplicates(rows, size, percent):
    """{doc_id: (n_shingles, component_id)} for (doc_id, text) rows with distinct ids."""
    sets = {d: shingles(t, size) for d, t in rows}
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= percent * len(sets[a] | sets[b]):
                    x, y = find(a), find(b)
                    up[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def kneser_ney(rows, trained):
    """{doc_id: (n_tokens, n_known, base_score, score)} of (doc_id, text) rows, and N."""
    import math
    from collections import Counter, defaultdict

    seqs = {d: words(t) + ["</s>!"] for d, t in rows}
    uni, bi = Counter(), Counter()
    for d in trained:
        uni.update(seqs[d])
        bi.update(zip(["<s>!"] + seqs[d][:-1], seqs[d]))
    n, v = sum(uni.values()), len(uni)
    after, before, free = defaultdict(int), Counter(), defaultdict(float)

    def discount(counts):
        k = [sum(c == i for c in counts) for i in (1, 2, 3, 4)]
        out = [0.0]
        for i in (1, 2, 3):
            if k[0] and k[1] and k[i - 1]:
                y = k[0] / (k[0] + 2 * k[1])
                out.append(min(max(i - (i + 1) * y * k[i] / k[i - 1], 0), i))
            else:
                out.append(i / 2)
        return out

    big = discount(bi.values())
    for (a, b), c in bi.items():
        after[a] += c
        free[a] += big[min(c, 3)]
        before[b] += 1
    low = discount(before.values())
    total = sum(before.values())
    g0 = sum(low[min(c, 3)] for c in before.values()) / total if total else 1
    out = {}
    for d, seq in seqs.items():
        base = s = 0.0
        for a, b in zip(["<s>!"] + seq[:-1], seq):
            base += math.log10((uni[b] + 0.1) / (n + 0.1 * (v + 1)))
            p = (max(before[b] - low[min(before[b], 3)], 0) / total if total else 0) + g0 / (v + 1)
            if after[a]:
                c = bi[a, b]
                p = max(c - big[min(c, 3)], 0) / after[a] + free[a] / after[a] * p
            s += math.log10(p)
        out[d] = (len(seq), sum(uni[w] > 0 for w in seq), base, s)
    return out, n


def plain(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())


def bag(words_, size):
    from collections import Counter

    return Counter(tuple(words_[i : i + size]) for i in range(len(words_) - size + 1))


def leaks(docs, items, percent):
    """{(doc_id, item_id, start, similarity)} of the best window for each pair that has one."""
    out = set()
    for d, t in docs:
        w = plain(t)
        for i, q in set(items):
            own = plain(q)
            n, best = len(own), None
            size = min(5, n)
            for s in range(len(w) - n + 1) if n else ():
                a, b = bag(w[s : s + n], size), bag(own, size)
                common = sum((a & b).values())
                sim = common / sum((a | b).values())
                if 100 * sim >= percent - 1e-9 and (best is None or sim > best[0]):
                    best = (sim, s)
            if best:
                out.add((d, i, best[1], round(best[0], 9)))
    return out


def best_dice(rows, templates, percent):
    """{doc_id: highest Dice of any stretch of lines with any template}, where it reaches the threshold."""
    out = {}
    for d, t in rows:
        lines = [plain(x) for x in (t or "").split("\n")]
        best = 0.0
        for i in range(len(lines)):
            for j in range(i, len(lines)):
                a = bag(sum(lines[i : j + 1], []), 2)
                for q in templates.values():
                    b = bag(plain(q), 2)
                    if a:
                        best = max(best, 2 * sum((a & b).values()) / (sum(a.values()) + sum(b.values())))
        if 100 * best >= percent:
            out[d] = round(best, 9)
    return out


def best_dice_of_words(rows, templates, percent):
    """{doc_id: highest Dice of any stretch of words with any template}, where it reaches the threshold."""
    out = {}
    for d, t in rows:
        w = plain(t)
        best = 0.0
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                a = bag(w[i:j], 2)
                for q in templates.values():
                    b = bag(plain(q), 2)
                    best = max(best, 2 * sum((a & b).values()) / (sum(a.values()) + sum(b.values())))
        if 100 * best >= percent:
            out[d] = round(best, 9)
    return out


def line_dedup_of_all(rows, least):
    """{doc_id: (n_removed, text)}: every run of at least `least` words that stands at any earlier place goes."""
    lines = {d: [(i, x, len(words(x))) for i, x in enumerate((t or "").split("\n")) if words(x)] for d, t in rows}
    gone, places = {d: set() for d in lines}, {}
    for d in sorted(lines):
        own = lines[d]
        for k, (_, text, _) in enumerate(own):
            for e, q in places.get(text, []):
                if k and q and own[k - 1][1] == lines[e][q - 1][1]:
                    continue  # inside a run that began before
                n = total = 0
                while k + n < len(own) and q + n < len(lines[e]) and own[k + n][1] == lines[e][q + n][1]:
                    total, n = total + own[k + n][2], n + 1
                if total >= least:
                    gone[d].update(range(own[k][0], own[k + n - 1][0] + 1))
            places.setdefault(text, []).append((d, k))
    return {
        d: (len(gone[d]), "\n".join(x for i, x in enumerate((t or "").split("\n")) if i not in gone[d]))
        for d, t in rows
    }


def kneser_ney_trigrams(rows, trained):
    """{doc_id: score} of (doc_id, text) rows: order 3, pairs by the number of distinct words before them."""
    import math
    from collections import Counter, defaultdict

    seqs = {d: ["<s>!"] + words(t) + ["</s>!"] for d, t in rows}
    tri, bi, uni = Counter(), Counter(), Counter()
    for d in trained:
        s = seqs[d]
        tri.update(zip(s, s[1:], s[2:]))
        bi.update(zip(s, s[1:]))
        uni.update(s[1:])
    before = Counter((b, c) for _, b, c in tri)
    pairs = {p: n if p[0] == "<s>!" else before[p] for p, n in bi.items()}
    singles = Counter(b for _, b in bi)

    def discounts(counts):
        k = [sum(c == i for c in counts) for i in (1, 2, 3, 4)]
        if not (k[0] and k[1]):
            return [0, 0.5, 1, 1.5]
        y = k[0] / (k[0] + 2 * k[1])
        return [0] + [min(max(i - (i + 1) * y * k[i] / k[i - 1], 0), i) if k[i - 1] else i / 2 for i in (1, 2, 3)]

    def level(table):
        d, total, free = discounts(table.values()), defaultdict(int), defaultdict(float)
        for g, c in table.items():
            total[g[:-1]] += c
            free[g[:-1]] += d[min(c, 3)]

        def p(g, lower):
            h = g[:-1]
            if not total[h]:
                return lower
            c = table.get(g, 0)
            return max(c - d[min(c, 3)], 0) / total[h] + free[h] / total[h] * lower

        return p

    p3, p2, p1 = level(tri), level(pairs), level({(w,): n for w, n in singles.items()})
    out = {}
    for d, s in seqs.items():
        out[d] = 0.0
        for i in range(1, len(s)):
            p = p2((s[i - 1], s[i]), p1((s[i],), 1 / (len(uni) + 1)))
            out[d] += math.log10(p3((s[i - 2], s[i - 1], s[i]), p) if i > 1 else p)
    return out


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def trie(conversations):
    """Nodes of {conv_id: [(role, text), ...]} as in `prefix_trie`, by plain dictionaries."""
    members = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for k in members:
        if k:
            children.setdefault(k[:-1], []).append(k)

    def below(k):
        yield k
        for c in children.get(k, []):
            yield from below(c)

    out = set()
    for k, cs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(conversations[c]) == len(k)))
        sub = list(below(k))
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in sub if x)
        leaves = sum(x not in children for x in sub)
        parent = min(members[k[:-1]]) if k else None
        out.add((min(cs), len(k), parent, len(cs), len(children.get(k, [])), leaves, saved, digest(ends)))
    return out


def merkle(groups):
    """(root, {group: root}, proofs) of {group: [leaf, ...]} (groups in order): levels as lists; a proof
    is a list of (left, right)."""

    def tree(leaves):
        levels, steps = [leaves], [[] for _ in leaves]
        while len(levels[-1]) > 1:
            below, k = levels[-1], len(levels)
            levels.append([digest("".join(below[i : i + 8])) for i in range(0, len(below), 8)])
            for i, s in enumerate(steps):
                at = i // 8 ** (k - 1)
                run = below[at // 8 * 8 : at // 8 * 8 + 8]
                s.append(("".join(run[: at % 8]), "".join(run[at % 8 + 1 :])))
        return levels[-1][0], steps

    trees = {g: tree(leaves) for g, leaves in groups.items()}
    root, tops = tree([r for r, _ in trees.values()])
    proofs = {(g, i): s + t for (g, (_, steps)), t in zip(trees.items(), tops) for i, s in enumerate(steps)}
    return root, {g: r for g, (r, _) in trees.items()}, proofs


def boilerplate_places(pages, run, least, share):
    """[{place: pages}] per page: starts of runs of `run` words found as plain substrings in enough distinct texts.

    `pages` are (host, text) with words parted by single spaces, lower-cased."""
    hosts = {}
    for host, text in pages:
        hosts.setdefault(host, set()).add(text)
    out = []
    for host, text in pages:
        w, places = text.split(" "), {}
        for i in range(len(w) - run + 1):
            part = f" {' '.join(w[i : i + run])} "
            n = sum(part in f" {other} " for other in hosts[host])
            if n >= least and n >= share * len(hosts[host]):
                places[i] = n
        out.append(places)
    return out
