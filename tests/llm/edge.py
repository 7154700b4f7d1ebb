"""Documents with the edge cases that every operator is held against."""

import random

SCHEMA = "doc_id long, text string, kept boolean, n long, bits int, component_id long, lang string"


def words(seed: int, n: int) -> list[str]:
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abcdefghé") for _ in range(rnd.randint(2, 8))) for _ in range(n)]


def rows() -> list[tuple]:
    base = words(1, 120)
    passage = " ".join(words(2, 60))
    near = list(base)
    near[50] = "changed"
    texts = [None, "", "   \n\t ", "one two", "one two", "a", " ".join(base), " ".join(base).replace(" ", "  \n"), " ".join(near), " ".join(words(3, 80)) + "\n" + passage, passage + "\n" + " ".join(words(4, 90)), " ".join(words(5, 30_000)), "x" * 20_000, " ".join(["same"] * 200), "ab ab\nab ab\n\nab ab", "NUL \x00 and \x1c and   é 😀 </s>[INST]", " ".join(words(6, 51))]
    out = [(i, t, False, -1, 7, 99, "en") for i, t in enumerate(texts)]
    return out + [out[6], out[6], (None, "no id at all", None, None, None, None, None)]
