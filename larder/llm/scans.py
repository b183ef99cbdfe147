"""Digests of ordered groups of any size (running totals: ``larder.plans.scans``)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def joined_sha256(rows: DataFrame, keys: list[str], value: str, at_once: int = 4096) -> DataFrame:
    """(keys, sha256): of each group's values as text, in ascending order, joined by commas.

    ``rows`` is a written table, keys and values are not null.  Groups are cut into texts of up
    to ``at_once`` values by tasks that share a group; SHA-256 itself has one order, so one task
    takes a group's texts, one at a time.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    first = f"{value} {rows.schema[value].dataType.simpleString()}"

    def texts(batches):
        import pyarrow as pa

        for b in batches:
            columns = [b.column(b.schema.get_field_index(k)).to_pylist() for k in (*keys, value)]
            out, last = [], None
            for *key, v in zip(*columns, strict=True):
                if key != last or len(out[-1][-1]) == at_once:
                    out.append([*key, v, []])
                    last = key
                out[-1][-1].append(str(v))
            if out:
                cut = [[*r[:-1], ",".join(r[-1])] for r in out]
                yield pa.RecordBatch.from_pylist([dict(zip((*keys, value, "part"), r, strict=True)) for r in cut], schema=pa.schema(
                    [b.schema.field(k) for k in (*keys, value)] + [pa.field("part", pa.string())]))

    def digests(batches):
        import hashlib

        import pyarrow as pa

        last = run = None
        for b in batches:
            out = []
            columns = [b.column(b.schema.get_field_index(k)).to_pylist() for k in (*keys, "part")]
            for *key, part in zip(*columns, strict=True):
                if key == last:
                    run.update(b",")
                else:
                    if last is not None:
                        out.append([*last, run.hexdigest()])
                    last, run = key, hashlib.sha256()
                run.update(part.encode())
            schema = pa.schema([b.schema.field(k) for k in keys] + [pa.field("sha256", pa.string())])
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip((*keys, "sha256"), r, strict=True)) for r in out], schema=schema)
        if last is not None:
            yield pa.RecordBatch.from_pylist([dict(zip((*keys, "sha256"), [*last, run.hexdigest()], strict=True))], schema=schema)

    parts = (rows.select(*keys, value).repartitionByRange(n, *keys, value).sortWithinPartitions(*keys, value)
             .mapInArrow(texts, f"{kinds}, {first}, part string"))
    return parts.repartition(n, *keys).sortWithinPartitions(*keys, value).mapInArrow(digests, f"{kinds}, sha256 string")
