"""Plain Python versions of the conversation repair, to hold the operator against."""

import hashlib
import itertools
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    """(conv_id, turn, role, text) after damage, in the given order."""
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def faults_of(rows):
    """'blank', 'duplicate', 'truncated' or '' per (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        solid = WORD.findall(text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """(cost, audit) by relaxing rows one by one over the states of the pattern; strings as they are."""
    steps = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    def inserted(states):
        states = dict(states)
        for _ in range(3):
            for state, (cost, audit) in list(states.items()):
                for r in "ua":
                    if (state, r) in steps:
                        offer(states, steps[state, r], (cost + 3, audit + "I"))
        return states

    def offer(states, state, value):
        if state not in states or value < states[state]:
            states[state] = value

    states = {"0": (0, "")}
    for (role, _), fault in zip(rows, faults):
        new = {}
        for state, (cost, audit) in inserted(states).items():
            offer(new, state, (cost + 4, audit + "D"))
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 if fault == "truncated" else 0
            if (state, role[:1]) in steps:
                offer(new, steps[state, role[:1]], (cost + extra, audit + "K"))
            for r in "ua":
                if (state, r) in steps:
                    offer(new, steps[state, r], (cost + extra + 3, audit + "R"))
        states = new
    states = inserted(states)
    return min(states[s] for s in ("0", "a") if s in states)


def enumerated(rows, faults):
    """(cost, audit) over every audit with at most three inserts in a gap."""
    best = None
    for edits in itertools.product("KRrD", repeat=len(rows)):
        for gaps in itertools.product(("", "u", "a", "ua", "au", "uau", "aua"), repeat=len(rows) + 1):
            roles, cost, audit = gaps[0], 3 * len(gaps[0]), "I" * len(gaps[0])
            for (role, _), fault, edit, gap in zip(rows, faults, edits, gaps[1:]):
                if edit != "D" and fault in ("blank", "duplicate"):
                    break
                if edit != "D" and fault == "truncated":
                    cost += 3
                cost += {"K": 0, "R": 3, "r": 3, "D": 4}[edit] + 3 * len(gap)
                roles += {"K": role[:1] or "-", "R": "u", "r": "a", "D": ""}[edit] + gap
                audit += edit.upper() + "I" * len(gap)
            else:
                if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
    return best


def replayed(rows, audit):
    total, line, out = len(audit) - audit.count("D"), 0, []
    rows = iter(rows)
    for edit in audit:
        role, text = (None, "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        out.append((role if edit == "K" else ("assistant" if (line - total % 2) % 2 else "user"), text))
        line += 1
    return out


def repaired(rows):
    """{conv: (gaps, blank, duplicate, truncated, illegal, cost, audit, digest)} of ordered (conv, turn, role, text)."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, role, text))
    out = {}
    for conv, found in convs.items():
        key = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest())
        found = sorted(found, key=key)
        pairs, turns = [r[1:] for r in found], [r[0] for r in found if r[0] is not None]
        faults = faults_of(pairs)
        firsts = [r[0][:1] for r in pairs]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:]))
        cost, audit = cheapest(pairs, faults)
        lines = "\n".join(f"{r}:{t}" for r, t in replayed(pairs, audit))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in (
            "blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest())
    return out
