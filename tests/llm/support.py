"""Plain Python versions of the contracts, and odd rows, for the operators' tests."""

import hashlib
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LONG = "lorem ipsum dolor sit amet " * 8000


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def odd_documents(spark):
    """Null and empty texts, a null id, repeated rows, a very long text, clashing columns."""
    rows = [(1, None, 7), (2, "", 7), (None, "no id here", 7), (3, "twice the same row", 7),
            (3, "twice the same row", 7), (4, LONG, 7), (5, "\n\t \r", 7), (6, "é🙂 日本語 ́x", 7)]
    clash = ["score", "N_WORDS", "secrets", "licences", "token_ids", "n_pii", "fingerprint", "item_ids", "kept", "p", "id"]
    schema = "doc_id long, text string, " + ", ".join(f"{c} int" for c in clash)
    return spark.createDataFrame([(a, b, *[c] * len(clash)) for a, b, c in rows], schema)
