"""Quotation linking on planted replies, against a plain implementation."""
import random
import re

from tidewater.llm import chat_format as c

SCHEMA = "conv_id bigint, turn bigint, role string, text string, own string"


def plain(rows):
    """(conv, turn) -> (text, reply_to), one row per message."""
    norm = lambda t: re.sub(r"[\s!-/:-@\[-`{-~]+", " ", t.lower()).strip()
    own, quotes = {}, {}
    for conv, turn, _, text, _ in rows:
        lines = []
        for line in re.split("\r?\n", text or ""):
            m = re.match(r"[ \t>]*>", line)
            lines.append((len(re.sub(r"[ \t]", "", m.group())), line[m.end():]) if m else (0, line))
        keep = [b for i, (lv, b) in enumerate(lines)
                if lv == 0 and not (i + 1 < len(lines) and lines[i + 1][0] > 0 and re.search(c.ANNOUNCES, b))]
        runs = []
        for lv, b in lines:
            if runs and runs[-1][0] == lv:
                runs[-1][1].append(b)
            else:
                runs.append((lv, [b]))
        own[conv, turn] = keep
        quotes[conv, turn] = [r for r in runs if r[0] > 0]
    units = lambda ls: {norm(x) for x in [" ".join(ls), *ls]} - {""}
    out = {}
    for (conv, turn), passages in quotes.items():
        votes = {}
        for lv, ls in passages:
            for u in units(ls):
                said = [t for (c2, t), o in own.items() if c2 == conv and t < turn and u in units(o)]
                if said:
                    votes[lv, max(said)] = votes.get((lv, max(said)), 0) + len(u)
        best = max(((-lv, n, t) for (lv, t), n in votes.items()), default=None)
        out[conv, turn] = ("\n".join(own[conv, turn]).strip("\n"), best and best[2])
    return out


def conversations(seed, n=30):
    r = random.Random(seed)
    rows = []
    for conv in range(n):
        said = []
        for turn in range(r.choice([1, 2, 5, 9])):
            mine = "\n".join(" ".join(r.choice("alpha beta gamma delta, yes. no!".split()) for _ in range(r.randint(1, 4))) for _ in range(r.randint(1, 3)))
            text = mine
            if said and r.random() < .7:
                src = r.choice(said)
                lines = src.split("\n")
                lines = lines[r.randrange(len(lines)):]
                quote = "\n".join(r.choice(["> ", ">", " >  "]) + x.upper() for x in lines)
                text = r.choice([f"On Monday A wrote:\n{quote}\n{mine}", f"{mine}\n{quote}", f"{quote}\n>> unknown words\n{mine}"])
            said.append(text)
            rows.append((conv, turn * 700, r.choice(["user", "assistant"]), text, None))
    return rows


def test_links_and_text(spark):
    rows = conversations(1) + conversations(2, 1)[:0]
    got = {(r.conv_id, r.turn): (r.text, r.reply_to) for r in c.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == plain(rows) and any(v[1] is not None for v in got.values())


def test_reply_order(spark):
    rows = [(1, 0, "user", "first thing", ""), (1, 1, "user", "other topic", ""), (1, 2, "assistant", "> first thing\nsure", ""),
            (1, 3, "assistant", "> other topic\nok", ""), (1, 4, "user", "> sure\n>> first thing\nthanks", ""), (1, 5, "user", "end", "")]
    got = sorted(c.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: r.order_key)
    assert [(r.turn, r.reply_to, r.depth) for r in got] == [(0, None, 0), (2, 0, 1), (4, 2, 2), (1, None, 0), (3, 1, 1), (5, None, 0)]
    assert got[2].formatted == "<|user|>\nthanks" and got[2].quote_levels == 2


def test_odd_rows(spark):
    rows = [(None, 1, "user", "> a", ""), (1, None, None, "a", ""), (1, 1, "user", None, ""), (1, 2, "user", "", ""),
            (1, 3, "user", ">" * 30_000 + "x", ""), (1, 4, "user", "say\n" * 20_000, ""), (1, 5, "x", "> say\nyes", ""), (1, 5, "x", "> say\nyes", "")]
    got = c.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    assert [r.reply_to for r in got if r.turn == 5] == [4, 4]
    assert all(r.order_key is None for r in got if r.conv_id is None or r.turn is None)
    assert c.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_long_conversation_is_looked_up_by_ranges(spark):
    rows = [(1, t, "u", "same line" if t % 10 == 0 else f"> same line\nanswer {t}" if t % 10 == 9 else f"t{t}", "") for t in range(0, 5000)]
    got = c.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(r.reply_to == r.turn - 9 for r in got if r.turn % 10 == 9)


def test_native_and_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    out = c.format_conversations(df)
    assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().toString())
    assert out.count() == df.count()
