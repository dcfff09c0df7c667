"""Plain versions of the contracts, for small inputs."""

import functools
import re
from itertools import combinations


def near(texts: dict, k: int) -> dict:
    """id -> (set size, smallest id reachable over pairs with a similarity of 0.8)."""
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    label = {i: i for i in sets}
    for a, b in combinations(sorted(sets), 2):
        if sets[a] and sets[b] and label[a] != label[b]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((label[a], label[b]))
                label = {i: low if x == high else x for i, x in label.items()}
    return {i: (len(s), label[i]) for i, s in sets.items()}


def url(text, rules):
    if text is None or "://" not in text:
        return "", "", None
    rest = text.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r[: r.index("/")] or host.endswith("." + r[: r.index("/")])) and path.startswith(r[r.index("/") :])]
    return host, path, max(fits, key=len, default=None)


def url_score(host, path, weights, size):
    import math

    slots = set()
    for text, salt in ((f"^{host}$", 0), (f"{path}$", 1231)):
        c = [ord(x) for x in text]
        slots |= {(a * 7919 + b * 10473 + d * 1299 + salt) % size for a, b, d in zip(c, c[1:], c[2:], strict=False)}
    return 1 / (1 + math.exp(-(weights[-1] + sum(weights[s] for s in slots) / math.sqrt(max(1, len(slots))))))


def phrases(text, base):
    w = words(text)
    at, labels = [], set()
    for phrase, label in base:
        p = phrase.split()
        for i in range(len(w)):
            if w[i : i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(w), at, labels


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contaminated(text, items):
    w, hit = words(text), set()
    for t in items.values():
        x = words(t)
        n = min(13, len(x))
        windows = {tuple(x[i : i + n]) for i in range(len(x) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in windows:
                hit.update(range(i, i + n))
    return bool(hit) and 20 * len(hit) >= len(w)


def water_fill(docs, weights, most):
    sizes: dict = {}
    for source, n in docs.values():
        sizes[source] = sizes.get(source, 0) + n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        open_ = sum(weight[s] for s in order if s not in capped)
        over = {s for s in order if s not in capped and left * weight[s] / open_ > most * sizes[s]} if open_ else set()
        if not over:
            return {s: most * sizes[s] if s in capped else left * weight[s] / open_ for s in order}
        capped |= over


def secrets(text):
    out = []
    kinds = [
        ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 6),
        ("access", "AKIA[A-Z0-9]+", 0, 0, 20),
        ("hex", "[0-9a-f]+", 0, 0, 24),
    ]
    for order, (kind, pattern, flags, group, least) in enumerate(kinds):
        out += [(m.start(), order, m.end(), kind) for m in re.finditer(pattern, text, flags) if len(m[group]) >= least]
    return sorted(out)


def lm_scores(texts, target, weights, types):
    """id -> (number of words, mean target loss, mean background loss), from plain counts of all other documents."""
    import math
    from collections import Counter

    w = {i: words(t) for i, t in texts.items()}
    theirs = [w, {i: x for i, x in w.items() if i in target}]
    every = [Counter(y for x in m.values() for y in x) for m in theirs]
    pairs = [Counter(p for x in m.values() for p in zip(x, x[1:], strict=False)) for m in theirs]
    totals = [sum(c.values()) for c in every]
    out = {}
    for i, x in w.items():
        loss, own, own_pairs = [0.0, 0.0], Counter(x), Counter(zip(x, x[1:], strict=False))
        for m in (0, 1):
            seen = i in theirs[m]
            for k, word in enumerate(x):
                p = weights[1] * (every[m][word] - own[word] * seen) / max(totals[m] - len(x) * seen, 1) + weights[2] / types
                if k:
                    p += weights[0] * (pairs[m][(x[k - 1], word)] - own_pairs[(x[k - 1], word)] * seen) / max(every[m][x[k - 1]] - own[x[k - 1]] * seen, 1)
                loss[m] -= math.log(p)
        out[i] = (len(x), loss[1] / max(len(x), 1), loss[0] / max(len(x), 1))
    return out


@functools.cache
def parsed(t):
    out, stack = [], []
    for mark in re.findall(r"<<[^>]*>>|[^\s<>]+", t):
        if mark == "<<beginOptional>>":
            stack.append(out)
            out = []
        elif mark == "<<endOptional>>":
            inner, out = out, stack.pop()
            out.append(("opt", inner))
        elif mark.startswith("<<var"):
            out.append(("var", int(mark[10:-2])))
        else:
            out.append(("word", mark))
    return out


def templates(text, listed):
    """Labels of the templates that match somewhere: a backtracking matcher over the parsed markup."""
    w, found = words(text), set()

    def ends(items, at):
        """All places at which the items can end."""
        places = {at}
        for kind, x in items:
            if not places:
                break
            if kind == "word":
                places = {p + 1 for p in places if p < len(w) and w[p] == x}
            elif kind == "var":
                places = {q for p in places for q in range(p, min(p + x, len(w)) + 1)}
            else:
                places |= {q for p in places for q in ends(x, p)}
        return places

    for t, label in listed:
        items = parsed(t)
        if any(ends(items, at) for at in range(len(w))):
            found.add(label)
    return found


def entropy_spans(text, classes, allowed):
    """(start, end, kind) of the entropy method, before base spans are looked at: every window's entropy from its own counts."""
    import math

    out = []
    for c in classes:
        for m in re.finditer(c.pattern, text):
            left, at = [], 0
            for x in re.finditer("|".join(allowed), m[0], re.I):
                left.append((at, m[0][at : x.start()]))
                at = x.end()
            for start, part in [*left, (at, m[0][at:])]:
                high = []
                for i in range(len(part) - c.window + 1):
                    w = part[i : i + c.window]
                    n = [w.count(ch) / c.window for ch in set(w)]
                    if -sum(p * math.log2(p) for p in n) >= c.entropy - 1e-9:
                        high.append(i)
                if high:
                    out.append((m.start() + start + high[0], m.start() + start + high[-1] + c.window, c.kind))
    return out


def taken(docs, target, most_whole, order):
    """id -> repeats for one source: docs (id, size), the seeded order, whole repetitions and the words that are missing then."""
    gap, extra = target, set()
    while fits := [i for i in order if i not in extra and 0 < docs[i] <= gap]:
        for i in fits:  # a pass takes what fits now, up to the first that would go over
            if docs[i] > gap:
                break
            extra.add(i)
            gap -= docs[i]
    near = [i for i in order if i not in extra and abs(docs[i] - gap) < gap]
    if near:
        extra.add(min(near, key=lambda i: (abs(docs[i] - gap), order.index(i))))
    return {i: most_whole + (i in extra) for i in docs}
