"""Small inputs with everything that a table may hold."""
import random

DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
              "fp string, score string, rule string, row_no int, sequence_id string, slot string, found string")
WORDS = ["river", "stone", "lantern", "meadow", "copper", "violin", "harbour", "thistle", "ember", "quartz", "willow", "saddle",
         "été", "größe", "niño", "cellar", "orchard", "pewter", "gravel", "hollow", "marble", "cinder", "barley", "falcon"]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", ".", ".\n"]) for _ in range(n))


def documents(spark, texts, ids=None):
    """Rows with clashing extra columns."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", None, len(t or ""), "x", None, "y", 1, None, "z", "w") for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def edge_texts():
    rng = random.Random(5)
    return [None, "", "   \n\t ", "one", prose(rng, 40), prose(rng, 40), "same text again", "same text again",
            prose(rng, 30_000), "\x00\x1c odd  spaces\r\n\nand\ttabs   wide", "中文 текст ελληνικά ς Σ ﬁ ́", "<|endoftext|> </s>[INST]"]
