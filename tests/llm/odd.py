"""Documents with every kind of row that an operator must bear."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept boolean, component_id string, score string, "
          "bucket string, block string, size string, chance string, start string, label string")
WHITE = " \t\n\x0b\x0c\r"


def _texts(seed=4):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["The", "the", "é", "日本", "a|b", "###", "x."]
    say = lambda n: "".join(rng.choice(words) + rng.choice(WHITE) for _ in range(n))
    base = [f"u{i}" for i in range(120)]
    near = [" ".join(w if j % 60 != k else f"edit{k}" for j, w in enumerate(base)) for k in range(4)]
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [say(rng.randrange(0, 200)) for _ in range(20)]
    texts += [None, "", " \n\t ", "one", "one two three", "one two three", passage, say(40) + passage, passage + " " + say(30), say(20_000)]
    texts += near + [near[0], near[0].upper(), "\n".join(["same line of text here"] * 30)]
    texts += ["<|endoftext|> 's", "a\xa0b c", "𝒳 \x00\x1c x\x7f"]
    return texts


def rows():
    """Repeated ids (the same and another text), missing ids, sources and texts."""
    made = []
    for i, text in enumerate(_texts()):
        doc_id = None if i in (5, 30) else i * 3 - 7
        made.append((doc_id, text, None, None if i % 7 == 6 else f"s{i % 3}", i, True, "c", "s", "b", "k", "z", "h", "t", "l"))
    return [*made, made[0], made[0], (made[1][0], *made[2][1:])]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)
