import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label string, gone_id long"

WORDS = "the of and to in that it was for on are as with they at be this from have or by one had not but what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has more her two like him see time could no make than first been its who now people my made over did down only way find use may water long little very after words called just where most know".split()


def prose(seed: int, n: int) -> str:
    """n words that differ from seed to seed, in lines of about twelve."""
    out, x = [], seed * 7919 + 17
    for i in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 16) % len(WORDS)] + ("\n" if i % 12 == 11 else " "))
    return "".join(out).strip()


def corpus() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and very long texts, ties, copies, near copies, a hot group and repeated rows."""
    rows: list[tuple[int | None, str | None]] = [(0, None), (1, ""), (2, " \n\t "), (3, "one two"), (4, "ONE  two"), (5, "one two three")]
    for i in range(6, 26):
        rows.append((i, prose(i, 20 + 13 * i)))
    base = prose(999, 200)
    rows += [(100 + i, base) for i in range(15)]
    words = base.split(" ")
    for i in range(15):
        changed = words.copy()
        changed[(7 * i) % len(words)] = f"w{i}"
        rows.append((200 + i, " ".join(changed)))
    chain = prose(55, 100).split()
    rows += [(300 + i, " ".join(chain[8 * i : 8 * i + 60])) for i in range(5)]
    rows += [(400, prose(77, 20_000)), (401, prose(77, 20_000) + " more"), (6, prose(6, 98)), (7, prose(8, 124)), (None, base), (None, None)]
    return rows


@pytest.fixture(scope="session")
def documents(spark):
    rows = [(i, t, ("en", "de", None)[(i or 0) % 3], "src0", None, "x", 1) for i, t in corpus()]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
