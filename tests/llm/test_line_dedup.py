"""What line deduplication keeps in storage and how it takes long texts, against plain Python."""

import random

from strikeloom.llm import line_dedup


def one_edit(a, b):
    """Whether two different strings are one replacement, insertion or deletion apart."""
    a, b = sorted((a, b), key=len)
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def test_lines_travel_as_hashes_and_equal_brute_force(spark, monkeypatch):
    pick, written = random.Random(8), []
    stored = line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", lambda rows: written.append(rows.columns) or stored(rows))
    lines = []
    for k in range(60):
        line = "".join(pick.choice("ab cd") for _ in range(pick.choice((19, 20, 21, 33, 48, 70))))
        line = "x" * 24 if k % 20 == 0 else f"<{line}>"
        for _ in range(pick.randrange(1, 4)):
            at = pick.randrange(len(line) + 1)
            lines.append(line[:at] + pick.choice(("", "x", "#")) + line[at + pick.randrange(2) :])
        lines.append(line)
    pick.shuffle(lines)
    docs = [(k, "\n".join(lines[3 * k : 3 * k + 3])) for k in range(len(lines) // 3)]
    lines = [line for _, text in docs for line in text.split("\n")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = {r.doc_id: r.n_removed for r in line_dedup.without_repeated_lines(frame, min_exact=1).collect()}
    gone = [
        any(a == b or min(len(a), len(b)) >= 20 and one_edit(a, b) for b in lines[:k]) for k, a in enumerate(lines)
    ]
    assert found == {k: sum(gone[3 * k : 3 * k + 3]) for k, _ in docs} and 20 < sum(gone) < len(gone) - 20
    # Only the candidates are written with their lines; nothing that is joined on stretches is.
    assert sum("line" in columns for columns in written) == 1


def test_a_text_of_many_lines_is_split_once(spark, monkeypatch):
    pick = random.Random(3)
    lines = [f"{pick.random()} {number}" for number in range(3_000)]
    frame = spark.createDataFrame([(1, "\n".join([*lines, lines[5]]))], "doc_id bigint, text string")
    result = line_dedup.without_repeated_lines(frame, min_exact=1)
    assert result.first().text == "\n".join(lines)
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    kept = plan[plan.index("array_except") - 400 : plan.index("array_except") + 400]
    # Not within the function that is called for each number.
    assert "lambdafunction(split(" not in kept and ", lambdafunction(split" not in plan
    assert "get(split(" not in plan.replace(" ", "")
