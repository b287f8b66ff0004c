"""Plain restatements of the operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def base_rules(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)}
    n, rep = len(words), len(covered)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), rep, n < 20 or 100 * rep > 30 * n


def shingles(text: str | None) -> set:
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def near_components(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """doc_id: (n_shingles, component) for distinct ids, over all pairs that
    share a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    by: dict = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    common = Counter((a, b) for v in by.values() for k, a in enumerate(v) for b in v[k + 1 :])
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for (a, b), c in common.items():
        if 100 * c >= 75 * (len(sets[a]) + len(sets[b]) - c):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


SECRETS = {
    "assign": re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "hex": re.compile("[0-9a-f]+"),
}


def base_secrets(text: str | None) -> list[tuple[int, str, int]]:
    out = []
    for k, (kind, pattern) in enumerate(SECRETS.items()):
        for m in pattern.finditer(text or ""):
            if (len(m[2]) >= 6) if kind == "assign" else m.end() - m.start() >= (20 if kind == "access" else 24):
                out.append((m.start(), k, kind, m.end()))
    return [(s, kind, e) for s, _, kind, e in sorted(out)]


def token_ids(texts: list[str | None], path: str, end_id: int) -> list[list[int]]:
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    return [e.ids + [end_id] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def check_pieces(pieces: list[tuple], ids: dict[int, list[int]], window: int = 2048) -> int:
    """Raise unless the pieces (doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset) hold each id once and fill sequences gaplessly; the
    padding that is left."""
    import struct
    import zlib
    from collections import defaultdict

    docs, seqs = defaultdict(list), defaultdict(list)
    for doc, start, length, crc, n, seq, offset in pieces:
        own = ids[doc][start : start + length]
        assert len(own) == length > 0 and n == len(ids[doc])
        assert zlib.crc32(struct.pack(f"<{length}I", *own)) == crc
        docs[doc].append((start, length))
        seqs[seq].append((offset, length))
    assert docs.keys() == ids.keys()
    for doc, found in docs.items():
        at = 0
        for start, length in sorted(found):
            assert start == at
            at += length
        assert at == len(ids[doc])
    padding = 0
    for found in seqs.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def chat_digests(turns: list[tuple]) -> dict:
    """conv_id: (n_turns, turns_sha256, loss_chars, loss_sha256) from rows
    (conv_id, turn, role, text)."""
    import hashlib

    out: dict = {}
    first = lambda x: (x is not None, x if x is not None else 0)
    for conv, _, role, text in sorted(turns, key=lambda r: (first(r[0]), first(r[1]), first(r[2]) if r[2] else (r[2] is not None, ""), (r[3] is not None, r[3] or ""))):
        n, h, chars, loss = out.setdefault(conv, [0, hashlib.sha256(), 0, hashlib.sha256()])
        h.update(f"{role or ''}\n{text or ''}\n".encode())
        out[conv][0] = n + 1
        if role == "assistant":
            out[conv][2] = chars + len(text or "")
            loss.update((text or "").encode())
    return {c: (n, h.hexdigest(), k, loss.hexdigest()) for c, (n, h, k, loss) in out.items()}


RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def url_base(url: str | None, rules=None) -> tuple:
    """(host, path, rule, the rule's verdict)."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate(LOWER)
    fits = [(len(h + p), h + p, v) for v, h, p in (RULES if rules is None else rules) if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def best_vectors(rows: list[tuple], k: int = 5, every: int = 50) -> list[tuple]:
    """(query_id, rank, vec_id, score) over distinct ids."""
    import math

    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok[i] = [math.floor(256 * x) for x in v]
    out = []
    for q, v in ok.items():
        if q % every == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok.items() if i != q and len(w) == len(v))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(found, 1)]
    return sorted(out)
