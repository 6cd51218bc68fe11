import json
import random
import re
from collections import Counter, defaultdict
from datetime import datetime, timezone

import pytest

from tracelake.llm.conversations import conversations

COLUMNS = "event_id long, session_key string, role string, content string, tool_calls string, tool_call_id string, timestamp_iso string, hash int, at string"


def micros(t):
    if t is None:
        return None
    d = datetime.fromisoformat(t.replace("Z", "+00:00"))
    d = d if d.tzinfo else d.replace(tzinfo=timezone.utc)
    d -= datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (d.days * 86400 + d.seconds) * 10**6 + d.microseconds


def ids(text):
    try:
        v = json.loads(text or "null")
    except ValueError:
        return []
    v = [v] if isinstance(v, dict) else v
    return [x.get("id") for x in v] if isinstance(v, list) else []


def seen(content):
    text = content or ""
    try:
        v = json.loads(text)
        if isinstance(v, list) and any(isinstance(x, dict) and "type" in x for x in v):
            text = "\n".join(x.get("text", "") for x in v if x.get("type") == "text")
    except ValueError:
        pass
    text = re.sub(r"(?s)<think>.*?(</think>|\Z)", "", text)
    return bool(re.sub(r"[\s\u200b\ufeff\u00a0]", "", text))


def brute(rows):
    sessions, out = defaultdict(dict), set()
    for e, s, role, content, calls, call, t, *_ in rows:
        if s is not None:
            key = ((role or "?").strip().lower(), micros(t), call, calls, content)
            sessions[s][key] = min(e, sessions[s].get(key, e))
    for s, ms in sessions.items():
        made = {}
        n = Counter()
        for (_, at, _, calls, _), e in ms.items():
            for ix, c in enumerate(ids(calls)):
                made[c] = (at, e, ix)
                n[c] += 1
        got = Counter(k[2] for k in ms if k[0] == "tool")
        if any(k[0] not in ("user", "assistant", "tool") for k in ms) or got != n or any(v != 1 for v in n.values()) or None in n or any(k[1] is None and k[0] != "tool" for k in ms):
            continue
        order = []
        for k, e in ms.items():
            a = made.get(k[2]) if k[0] == "tool" else None
            order.append(((a[0], a[1], 1, a[2]) if a and (k[1] is None or k[1] <= a[0]) else (k[1], e, 0, 0), e, k))
        order.sort(key=lambda x: (x[0], x[1]))
        answered = None
        for _, _, k in order:
            if k[0] == "user":
                if answered is False:
                    break
                answered = False
            elif answered is None:
                break
            elif k[0] == "assistant" and not ids(k[3]) and seen(k[4]):
                answered = True
        else:
            if answered:
                out |= {(s, i + 1, e) for i, (_, e, _) in enumerate(order)}
    return out


def made_rows(seed):
    r, rows, event = random.Random(seed), [], 0
    stamp = lambda t: r.choice([f"2026-01-05T00:{t // 60:02}:{t % 60:02}", f"2026-01-05 00:{t // 60:02}:{t % 60:02}.500", f"2026-01-05T02:{t // 60:02}:{t % 60:02}.25+02:00", f"2026-01-05T00:{t // 60:02}:{t % 60:02}Z"])
    for k in range(120):
        t, call, lost = 0, 0, r.random() < 0.2
        for _ in range(r.randint(0, 3)):
            t += r.randint(1, 9)
            rows.append((event := event + 1, f"s{k}", r.choice(["user", "User ", "USER"]), r.choice(["q?", None, '[{"type": "image", "image": "a"}]']), None, None, stamp(t), 1, "x"))
            for _ in range(r.randint(0, 2)):
                t += r.randint(0, 4)
                names = [f"c{call + i}" for i in range(r.randint(1, 3))]
                call += len(names)
                text = json.dumps([{"id": c, "function": {"name": "f", "arguments": "{}"}} for c in names])
                text = text[1:-1] if len(names) == 1 and r.random() < 0.5 else text
                rows.append((event := event + 1, f"s{k}", "assistant", None, text[:-4] if r.random() < 0.03 else text, None, stamp(t), 1, "x"))
                for c in names:
                    own = stamp(t + r.randint(-3, 5)) if t > 3 and r.random() < 0.7 else r.choice([None, "1970-01-01T00:00:00"])
                    if not (lost and r.random() < 0.2):
                        rows.append((event := event + 1, f"s{k}", " tool", "x", None, None if lost and r.random() < 0.1 else c, own, 1, "x"))
            t += r.randint(1, 9)
            rows.append((event := event + 1, f"s{k}", r.choice(["assistant"] * 30 + ["system", None]), r.choice(["a"] * 12 + ["<think>x</think>", "<think>x", "​ \n", None, "<think>b</think>c", '[{"type": "text", "text": " "}]', "[0.1, 0.2]"]), r.choice([None, "[]", "nope"]), None, stamp(t), 1, "x"))
    rows += r.sample(rows, 40)
    rows += [(event := event + 1, *x[1:]) for x in r.sample(rows, 60)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rows = made_rows(seed) + [(10**6, None, "user", "q", None, None, "2026-01-05T00:00:00Z", 1, "x")]
    got = [tuple(x)[:3] for x in conversations(spark.createDataFrame(rows, COLUMNS)).collect()]
    expect = brute(rows)
    assert len(expect) > 200
    assert len(got) == len(set(got))
    assert set(got) == expect


def test_empty_table(spark):
    assert conversations(spark.createDataFrame([], COLUMNS)).count() == 0


def test_one_session_of_many_ranges(spark):
    rows = []
    for k in range(2000):
        rows.append((2 * k + 1, "hot", "user", f"q{k}", None, None, f"2026-01-05T{k // 3600:02}:{k // 60 % 60:02}:{k % 60:02}Z", 1, "x"))
        rows.append((2 * k + 2, "hot", "assistant", f"a{k}", None, None, f"2026-01-05T{k // 3600:02}:{k // 60 % 60:02}:{k % 60:02}.5Z", 1, "x"))
    got = {(x.turn_no, x.event_id) for x in conversations(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert got == {(k, k) for k in range(1, 4001)}
