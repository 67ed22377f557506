"""Plain restatements of the contracts, one document at a time."""

from __future__ import annotations

import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOW = {c: c + 32 for c in range(65, 91)}

#: Texts that most operators must get through: null, empty, blank, short, long, ties, odd characters.
EDGE = [
    None, "", "   \n\t ", "a", "A a", "one two three four", "one two three four five", "É́ ß — x\x85y \x1f z",
    "key " * 3000, "x" * 50_000, "1 " * 8000, "a." * 8000 + "@" + "b." * 8000 + "c", "+1 " + "2" * 30000, "9" * 40_000, "tok <|endoftext|> it's 3.14!!",
]


def lower(t: str | None) -> str:
    return (t or "").translate(_LOW)


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def secrets(text: str | None) -> tuple[int, int, int, str]:
    text, found = text or "", []
    for m in re.finditer(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    n = [sum(k == i for _, k, _ in found) for i in range(3)]
    return (*n, sha(",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{z}" for a, k, z in sorted(found))))


def luhn(d: str) -> bool:
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def personal(text: str | None) -> tuple[list, str]:
    """Base spans, and all spans joined as the contract has it."""
    text, found = text or "", []
    for m in re.finditer(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text) if len(text) > 5000 else re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((0, m.start(), m.end()))
    for m in re.finditer(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((1, m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            found.append((2, m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((3, m.start(), m.end()))
    base = sorted(found)
    for m in re.finditer(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])", text):
        v = m[0].replace(" ", "")
        if int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1:
            found.append((4, m.start(), m.end()))
    return base, ",".join(f"{('email', 'ip', 'card', 'phone', 'iban')[k]}:{a}:{z}" for k, a, z in sorted(found))


def pii(text: str | None) -> tuple[int, int, int, int, str]:
    base = personal(text)[0]
    n = [sum(k == i for k, _, _ in base) for i in range(4)]
    return (*n, sha(",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{a}:{z}" for k, a, z in base)))


def hits(docs: dict, items: dict, span: int = 10) -> dict:
    windows: dict[tuple, set] = {}
    for i, t in items.items():
        w = ALNUM.findall(lower(t))
        for a in range(len(w) - span + 1) if len(w) >= span else range(bool(w)):
            windows.setdefault(tuple(w[a : a + span]), set()).add(str(i))
    sizes = {len(w) for w in windows}
    out = {}
    for d, t in docs.items():
        w = ALNUM.findall(lower(t))
        hit, found = set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                if of := windows.get(tuple(w[a : a + n])):
                    hit.update(range(a, a + n))
                    found |= of
        out[d] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))
    return out


def shingles(text: str | None, k: int = 5) -> set:
    w = WORD.findall(lower(text))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(docs: dict) -> dict:
    sets = {d: shingles(t) for d, t in docs.items()}
    up = {d: d for d in docs}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    where: dict = {}
    for d, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(d)
    for d, s in sets.items():
        for o in {o for x in s for o in where[x] if o < d}:
            if 100 * len(s & sets[o]) >= 80 * len(s | sets[o]):
                a, b = sorted((top(d), top(o)))
                up[b] = a
    return {d: (len(sets[d]), top(d)) for d in docs}


def repeated(docs: dict, span: int = 50) -> dict:
    """Words of each text inside a window of `span` words that occurs more than once in the corpus."""
    seen: dict = {}
    for d, t in docs.items():
        w = WORD.findall(lower(t))
        for a in range(len(w) - span + 1):
            seen.setdefault(tuple(w[a : a + span]), []).append((d, a))
    out: dict = {d: set() for d in docs}
    for places in seen.values():
        if len(places) > 1:
            for d, a in places:
                out[d].update(range(a, a + span))
    return out


def ids_of(texts: list, end: int) -> list:
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [[*x.ids, end] for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def crc(ids: list) -> int:
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def merkle(text: str | None) -> str:
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    heads, parts = [], []
    for section in re.split(r"(?<=\n\n)(?!\n)", text or ""):
        paras, shown = [], []
        for para in re.split(r"(?<=\n)", section):
            leaves = []
            for x in re.split("(?<=[.!?|;:] )|(?<=[\u3002\uff01\uff1f])", para):
                leaves += [x] if len(x) <= 32 else re.findall(r"(?a:\S{1,64}+\s*+|\s++){1,32}+", x)
            leaves = [md5(x) for x in leaves]
            paras.append(md5(",".join(leaves)))
            shown.append(paras[-1][:8] + ":" + ",".join(x[:8] for x in leaves))
        heads.append(md5(",".join(paras)))
        parts.append(heads[-1][:16] + "{" + "/".join(shown) + "}")
    return sha(",".join(heads)) + ";" + ";".join(parts)


def likeness(a: str, b: str) -> float:
    x, y = (set(re.findall("[0-9a-f]{8}(?=[,/}])", f)) for f in (a, b))
    return 1.0 if a[:64] == b[:64] else 2 * len(x & y) / (len(x) + len(y))


def first_difference(a: str, b: str) -> str | None:
    if a[:64] == b[:64]:
        return None
    tree = lambda f: [[p[9:].split(",") for p in s[17:-1].split("/")] for s in f.split(";")[1:]]
    at = []
    x, y = tree(a), tree(b)
    for _ in range(3):
        i = next((i for i in range(max(len(x), len(y))) if x[i : i + 1] != y[i : i + 1]), len(y))
        at.append(i)
        x, y = ((z[i] if i < len(z) else []) for z in (x, y))
    return "/".join(map(str, at))


def tree_scores(train: list, texts: list, depth: int, least: int, gain: float, smooth: float) -> list[float]:
    """Scores by a suffix tree of dictionaries: contexts are byte strings, the last symbol before a place last."""
    import math
    from collections import Counter, defaultdict

    marks, end = b"\t" * depth, b"\n"
    symbols = lambda t: marks + " ".join(WORD.findall(lower(t))).encode() + end
    seen = defaultdict(Counter)
    for t in train:
        s = symbols(t)
        for i in range(depth, len(s)):
            for d in range(depth + 1):
                seen[s[i - d : i]][s[i]] += 1
    root = {x: (seen[b""][x] + 1) / (sum(seen[b""].values()) + 256) for x in range(256)}

    def p(ctx: bytes, x: int) -> float:
        if not ctx:
            return root[x]
        n = seen[ctx] if ctx in seen else Counter()
        return (n[x] + smooth * p(ctx[1:], x)) / (sum(n.values()) + smooth)

    kept = {b""}
    for ctx, n in list(seen.items()):
        if ctx and (len(ctx) == 1 or sum(n.values()) >= least) and sum(c * math.log(p(ctx, x) / p(ctx[1:], x)) for x, c in n.items()) >= gain:
            kept |= {ctx[i:] for i in range(len(ctx) + 1)}
    out = []
    for t in texts:
        s = symbols(t)
        out.append(sum(math.log10(p(next(s[i - d : i] for d in range(depth, -1, -1) if s[i - d : i] in kept), s[i])) for i in range(depth, len(s))))
    return out
