import hashlib
import math
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from sparkprep.llm.line_templates import drop_recurring_lines, op7_line_dedup
from cases import ODD

LICENCE = "This work is licensed under version 3"


def dropped(df, **options):
    rows = drop_recurring_lines(df, **options).collect()
    return {r.doc_id: (list(r.dropped), r.kept_text) for r in rows}


def test_recurring_lines_go_and_own_lines_stay(table, prose):
    rows = []
    for i in range(8):
        lines = prose(60, i).split("\n")
        if i < 4:
            lines.insert(i, LICENCE)
        if i >= 6:
            lines.insert(1, "Only two documents have this line")
        rows.append((i, "\n".join(lines)))
    found = dropped(table(rows, extra=True))
    for i, text in rows:
        if i < 4:
            assert found[i] == ([i], "\n".join(x for x in text.split("\n") if x != LICENCE))
        else:
            assert found[i] == ([], text)


def test_variable_fields_are_generalised(table, prose):
    """Numbers, and words that differ while the rest of the leaf agrees, make one template."""
    names = ["anna", "bert", "carl", "dora", "emil", "fred"]
    rows = [
        (i, f"{prose(60, i)}\nPage {i} of 17 printed\nThis text was sent to us by {n} on a monday morning")
        for i, n in enumerate(names)
    ]
    found = dropped(table(rows))
    assert all(f[0] == [4, 5] for f in found.values())


def test_copies_are_not_emptied(table, prose):
    """Lines that only copies share are theirs; what others have too goes from copies as well."""
    text = prose(90, 1)
    changed = text.split("\n")
    near = ["\n".join([*changed[:k], prose(15, 50 + k), *changed[k + 1 :]]) for k in range(5)]
    own = [prose(60, 10 + k) + "\n" + LICENCE for k in range(3)]
    rows = list(enumerate([text] * 4 + near + own + [text + "\n" + LICENCE]))
    found = dropped(table(rows))
    for i, t in rows:
        assert found[i][1] == "\n".join(x for x in t.split("\n") if x != LICENCE)


def test_hot_line_and_ties(table, prose):
    rows = [(i, f"{LICENCE}\n{prose(45, i)}\n{LICENCE}") for i in range(200)]
    found = dropped(table(rows).repartition(4))
    assert Counter(len(d) for d, _ in found.values()) == {2: 200}


def test_odd_rows(table):
    rows = drop_recurring_lines(table(ODD, extra=True)).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(ODD)
    assert all(r.kept_text == r.text and not r.dropped for r in rows)
    assert drop_recurring_lines(table([])).count() == 0
    found = drop_recurring_lines(table(ODD)).where(F.col("text").isNull()).collect()
    assert all(r.n_lines == 0 for r in found)


def test_no_python_on_the_main_path(spark, table, prose):
    df = drop_recurring_lines(table([(i, prose(60, i) + "\n" + LICENCE) for i in range(5)]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_short_lines_recur_too(table, prose):
    """One to three tokens: the same line goes; blank lines and lines that differ in a number stay."""
    short = ["Imprint", "About us", "All rights reserved."]
    rows = [(i, "\n".join([*short, "", " ", f"Part {i}", prose(60, i)])) for i in range(5)]
    found = dropped(table(rows))
    assert all(f[0] == [0, 1, 2] for f in found.values())
    assert all(not f[0] for f in dropped(table(rows[:2])).values())


def test_two_families_in_a_leaf(table, prose):
    """Same length and first tokens: each family is dropped, with the other beside it or without."""
    names = ["anna", "bert", "carl", "dora", "emil", "fred", "gina", "hugo", "ines", "jost", "kurt", "lena"]
    days = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday", "weekend"]
    one = [f"This page was written by {n} for our dear readers" for n in names]
    two = [f"This page was last changed on {d} by staff" for d in days]
    two = [t.replace("by staff", "by our staff") for t in two]
    assert {len(x.split()) for x in one + two} == {10}
    for lines in (one, two, one + two):
        found = dropped(table([(i, f"{prose(60, i)}\n{x}") for i, x in enumerate(lines)]))
        assert all(f[0] == [4] for f in found.values())


def test_lines_that_only_begin_alike_stay(table, prose):
    rows = [(i, f"{prose(60, i)}\nIt was the {prose(9, 500 + i).replace(chr(10), ' ')}") for i in range(20)]
    assert all(not f[0] for f in dropped(table(rows)).values())


def test_large_notices_go(table, prose):
    """A notice of 90 words on pages of 60 own words; the same notice over copies of one page stays there."""
    notice = prose(90, 999)
    rows = [(i, f"{notice}\n{prose(60, i)}") for i in range(20)]
    for i, f in dropped(table(rows)).items():
        assert f[1] == rows[i][1][len(notice) + 1 :]
    same = [(i, f"{prose(300, 7)}\n{prose(40, 100 + i)}") for i in range(5)]
    assert all(not f[0] for f in dropped(table(same)).values())


def test_many_lines_in_a_text(table, prose):
    """100,000 lines, in linear time."""
    long = "\n".join(x for i in range(50_000) for x in (LICENCE, f"{i:x} words of line {i} {i * 7919 % 104729}"))
    rows = [(0, long)] + [(i, f"{prose(60, i)}\n{LICENCE}") for i in range(1, 6)]
    found = dropped(table(rows))
    assert found[1][0] == [4]
    assert found[0][1].count(LICENCE) == 0


def brute(rows, depth=3, least=3, least_tokens=4, agreement=0.7, own_words=30):
    """Places of dropped lines for each text, by the rule as it is stated."""
    texts = {t for _, t in rows if t is not None}
    lines = {}  # (text, place) -> (leaf, line, words)
    for t in texts:
        for k, line in enumerate(t.split("\n")):
            if not re.search(r"[^ \t\n\x0b\f\r]", line):
                continue
            masked = re.sub(r"(?<![^ ])[^ 0-9]*[0-9][^ ]*", "<*>", line).strip(" ")
            tokens = tuple(masked.split(" "))
            if len(tokens) < least_tokens:
                lines[t, k] = ((line.strip(" "),), line.strip(" "), tokens)
            else:
                lines[t, k] = ((len(tokens), *tokens[:depth]), masked, tokens)
    held = defaultdict(set)
    for (t, _), (leaf, line, tokens) in lines.items():
        held[leaf, line, tokens].add(t)
    leaves, at = defaultdict(list), Counter()
    for (leaf, line, tokens), where in held.items():
        leaves[leaf].append(len(where))
        for k in range(depth, len(tokens)):
            at[leaf, k, tokens[k]] += len(where)
    template = {}
    for leaf, line, tokens in held:
        total = sum(leaves[leaf])
        counts = {k: at[leaf, k, tokens[k]] for k in range(depth, len(tokens))}
        counts = {k: n for k, n in counts.items() if n >= least}
        template[leaf, line] = line
        if len(leaves[leaf]) < 2 or total < least or not counts:
            continue
        rank = math.ceil(agreement * (len(tokens) - depth)) - 1
        family = sorted(counts.values(), reverse=True)[rank] if rank < len(counts) else None
        if sum(n >= agreement * total for n in counts.values()) + depth >= agreement * len(tokens):
            family = total
        if family:
            fixed = tuple((k, tokens[k]) for k, n in counts.items() if n >= agreement * family)
            template[leaf, line] = (leaf, fixed)
    spread = defaultdict(set)
    for (t, k), (leaf, line, _) in lines.items():
        spread[template[leaf, line]].add(t)
    recurs = {x for x, where in spread.items() if len(where) >= least}
    placed = defaultdict(list)
    for (t, k), v in sorted(lines.items(), key=lambda x: x[0][1]):
        placed[t].append((k, *v))
    remainder = {}
    for t in texts:
        mine = placed[t]
        own = [(k, line, tokens) for k, leaf, line, tokens in mine if template[leaf, line] not in recurs]
        size = lambda ks: sum(len(t.split("\n")[k]) for k in ks)
        mine_size, own_size = size(m[0] for m in mine), size(o[0] for o in own)
        words = sum(len(o[2]) for o in own)
        if own and (2 * own_size >= mine_size or (4 * own_size >= mine_size and words >= own_words)):
            remainder[t] = tuple(sorted(o[1] for o in own))
    gone = {x for x in recurs if len({remainder[t] for t in spread[x] if t in remainder}) >= least}
    return {
        t: [k for k, leaf, line, _ in placed[t] if template[leaf, line] in gone] for t in texts
    }


def test_query_against_brute_force(spark):
    """The registered query on whole tables: dropped places and what is left."""
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    wanted = brute(rows)
    found = {r.doc_id: r for r in op7_line_dedup(spark, folder).collect()}
    assert len(found) == len(rows)
    for i, t in rows:
        gone = wanted.get(t, [])
        left = t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in set(gone))
        assert found[i].dropped_lines == ",".join(map(str, gone))
        assert found[i].kept_sha256 == hashlib.sha256((left or "").encode()).hexdigest()


def test_names_of_own_columns_are_kept(table, prose):
    rows = [(i, f"{prose(60, i)}\n{LICENCE}") for i in range(5)]
    for name in ("_hash", "_dropped", "_doc", "row", "_key"):
        found = drop_recurring_lines(table(rows).withColumn(name, F.lit("mine"))).collect()
        assert all(r[name] == "mine" and r.dropped == [4] for r in found)
