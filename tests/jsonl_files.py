import json
import os


def write_jsonl(path, rows):
    """Write rows (dicts or raw strings) as JSON lines."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        for r in rows:
            fh.write((r if isinstance(r, str) else json.dumps(r)) + "\n")
    return path
