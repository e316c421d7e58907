import hashlib
import itertools
import random
import re
import zlib

from lumbung.llm import turns
from lumbung.llm.earley import Chart, Grammar, Rule

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
LEGAL = re.compile(r"(s?(ua)+)?")


def plain_repair(tokens):
    """Cheapest (cost, audit, roles) by a table over positions and what the output ends with: another way to the same result."""
    best = {"": (0, "", ())}

    def insert(states):
        for _ in range(2):
            for ends, (cost, audit, roles) in list(states.items()):
                to = {"": "u", "s": "u", "a": "u", "u": "a"}[ends]
                states[to] = min(states.get(to, (10**9,)), (cost + 3, audit + "I", (*roles, ("I", to))))
        return states

    best = insert(best)
    for initial, fault in tokens:
        new = {}
        for ends, (cost, audit, roles) in best.items():
            options = [(4, "D", ends, roles)]
            if fault not in (1, 2):
                extra, to = 3 if fault == 3 else 0, "a" if ends == "u" else "u"
                options.append((3 + extra, "R", to, (*roles, ("R", to))))
                if initial == to or (initial == "s" and ends == ""):
                    options.append((extra, "K", initial, (*roles, ("K", initial))))
            for add, letter, to, made in options:
                new[to] = min(new.get(to, (10**9,)), (cost + add, audit + letter, made))
        best = insert(new)
    return min(best[e] for e in ("", "a") if e in best)


def brute(rows, damaged):
    """What report() and damaged_report() give, in plain Python. rows: conv_id, turn, role, text."""
    found = {}
    for conv_id, turn, role, text in rows:
        kept = found.setdefault(conv_id, [])
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
        if code == 1:
            text = ""
        elif code == 2:
            text = re.sub("[.!?]", "", text)
        elif code == 4:
            role = "user"
        kept += [(turn is not None, turn or 0, role.encode(), text.encode())] * {0: 0, 3: 2}.get(code, 1)
    out = []
    for conv_id, kept in found.items():
        kept.sort()
        known, seen, tokens, faults = [t for has, t, _, _ in kept if has], set(), [], [0] * 4
        for _, _, role, text in kept:
            bare = text.decode().strip(BLANKS)
            fault = 1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0
            seen.add((role, text))
            faults[fault] += 1
            tokens.append((role.decode()[:1], fault))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(tokens))
        cost, audit, _ = plain_repair(tokens)
        lines, at, place = [], 0, 0
        first = next((x for x in audit if x != "D"), None)
        led = first == "K" and tokens[next(i for i, x in enumerate(audit) if x != "D")][0] == "s"
        for letter in audit:
            role = "user" if (place - led) % 2 == 0 else "assistant"
            if letter == "I":
                lines.append(f"{role}:")
            else:
                if letter != "D":
                    lines.append(f"{role if letter == 'R' else kept[at][2].decode()}:{kept[at][3].decode()}")
                at += 1
            place += letter != "D"
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        out.append((conv_id, gaps, *faults[1:], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def plain(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "conv_id long, turn long, role string, text string, gone string, digest string, copy long")


def conversations(n, seed):
    r = random.Random(seed)
    for conv_id in range(n):
        for turn in range(r.randint(1, 12)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "unknown", None])
            yield conv_id, r.choice([turn, turn, turn + r.randint(0, 9), None]), role, r.choice(["Yes.", "No!", "", " \t\n", "cut off", "Really?  ", None, f"Text {r.random()}.", "a. b"])


def test_against_brute_force(spark):
    rows = list(conversations(250, 1))
    assert plain(turns.report(frame(spark, rows))) == brute(rows, False)
    assert plain(turns.damaged_report(frame(spark, rows).repartition(5))) == brute(rows, True)


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 3, "user", "Hi."), (1, 0, "user", "x" * 200_000 + "."), (1, 0, "user", "x" * 200_000 + "."), (2, -5, "system", "S."), (2, 2**40, "user", "."), (3, 7, "système", "É!\n\n")]
    assert plain(turns.report(frame(spark, rows))) == brute(rows, False)
    assert turns.report(frame(spark, [])).collect() == []
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert plain(turns.damaged_report(frame(spark, [(gone, 0, "user", "Hi.")]))) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repeated_rows_of_a_turn(spark):
    rows = [(c, t, "user", "Same.") for c in range(40) for t in (0, 0, 1, 1, 1)] + [(c, 0, "assistant", "Other.") for c in range(40)]
    assert plain(turns.report(frame(spark, rows).repartition(7))) == brute(rows, False)


def test_long_conversations_pass_as_a_stream(spark):
    r = random.Random(5)
    rows = [(1, t, r.choice(["user", "assistant", "tool"]), r.choice(["Yes.", f"T{t}.", "cut", ""])) for t in range(3000)] + [(2, t, ["user", "assistant"][t % 2], f"T{t}.") for t in range(500)]
    assert plain(turns.report(frame(spark, rows))) == brute(rows, False)
    chart, held = Chart(turns.GRAMMAR, turns.match, turns.SLACK), 0
    for t in range(3000):
        chart.push((r.choice("uast"), r.choice([0, 0, 1, 3])))
        if t % turns.SETTLE == 0:
            chart.settled()
        held = max(held, len(chart.sets), sum(map(len, chart.sets.values())))
    open_ = max(audit.depth for _, audit in chart.sets[chart.at].values()) - chart.root.depth
    assert held < 120 and open_ < 200


def test_all_short_conversations():
    kinds = [(i, f) for i in "usat" for f in (0, 1, 3)]
    for n in range(4):
        for tokens in itertools.product(kinds, repeat=n):
            cost, audit, roles = plain_repair(tokens)
            found = turns.cheapest(tokens)
            assert (found[0], "".join(x for x, _ in found[1])) == (cost, audit)
            assert LEGAL.fullmatch("".join(r for _, r in roles))


def test_nothing_cheaper_exists():
    """The table that the tests compare with, against trying all edits."""
    r = random.Random(2)
    for _ in range(60):
        tokens = [(r.choice("usat"), r.choice([0, 0, 1, 2, 3])) for _ in range(r.randint(0, 4))]
        best = None
        for edits in itertools.product("DRK", repeat=len(tokens)):
            for inserts in itertools.product(range(3), repeat=len(tokens) + 1):
                audit = "".join("I" * k + e for k, e in zip(inserts, edits, strict=False)) + "I" * inserts[-1]
                cost, ends, at, ok = 0, "", 0, True
                for letter in audit:
                    to = "a" if ends == "u" else "u"
                    initial, fault = tokens[at] if letter != "I" else ("", 0)
                    at += letter != "I"
                    if letter == "D":
                        cost += 4
                        continue
                    ok = ok and fault not in (1, 2)
                    cost += {"I": 3, "R": 3, "K": 0}[letter] + (3 if fault == 3 else 0)
                    if letter == "K":
                        ok = ok and (initial == to or (initial == "s" and ends == ""))
                        to = initial
                    ends = to
                if ok and ends in ("", "a"):
                    best = min(best or (10**9, ""), (cost, audit))
        assert best == plain_repair(tokens)[:2]


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "tool", "T."), (1, 2, "assistant", "A."), (1, 3, "assistant", "B."), (1, 4, "user", "")]
    found = [tuple(r) for r in turns.repair(frame(spark, rows)).orderBy("place").collect()]
    assert found == [(1, 1, 0, "system", "S.", "K"), (1, 2, 1, "user", "T.", "R"), (1, 3, 2, "assistant", "A.", "K"), (1, 4, None, "user", "", "I"), (1, 5, 3, "assistant", "B.", "K")]


def test_other_grammars():
    """Balanced pairs, which recur in the middle: items that begin anywhere."""
    grammar = Grammar("S", (Rule("S", ()), Rule("S", ("S", "P")), Rule("P", ("a", "S", "B")), Rule("B", ("b",)), Rule("B", (), 2, "I")))
    chart = Chart(grammar, lambda terminal, token: (0, "K", "") if terminal == token else None, 1000)
    for token in "aabab":
        chart.push(token)
    cost, audit = chart.finish()
    assert (cost, "".join(a.letter for a in audit)) == (2, "KIKKKK")
