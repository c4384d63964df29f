"""Test input: small tables as the JSON arrays that reference files hold."""
import json


def write_reference_array(df, path):
    rows = [json.loads(r) for r in df.toJSON().collect()]
    with open(path, "w", encoding="utf-8") as f:
        json.dump(rows, f, indent=2)
