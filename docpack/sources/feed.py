"""The stream source ``docpack_feed``: the changes of a store in the order in which they were written.

    spark.dataSource.register(StoreFeed)
    spark.readStream.format("docpack_feed").load(root)

The offset is the number of the store's last write. A batch has the documents of the changes since the last one, with ``_seq``, the number
of their change, so compaction, which changes no document, brings none. Where changes are no longer kept, or a store was
loaded at once, the batch has the whole store (documents of its buckets with ``_seq`` 0). ``maxChanges`` bounds a batch; ``log``, a file of the
stream's own, then remembers where the last one ended.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pfs
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from docpack.model import DOC
from docpack.sources.archive import file_system

SCHEMA = f"{DOC}, _seq long"
_KINDS = {"string": pa.string(), "long": pa.int64(), "map<string,string>": pa.map_(pa.string(), pa.string())}
ARROW = pa.schema([pa.field(name, _KINDS[kind]) for name, kind in (x.split(" ", 1) for x in SCHEMA.split(", "))])
ROWS = 2000


@dataclass
class File(InputPartition):
    path: str = ""
    seq: int = 0

    def __post_init__(self):
        super().__init__(self.path)


class FeedReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.root = options["path"].rstrip("/")
        self.most, self.log = int(options.get("maxChanges", 0)), options.get("log")
        if self.most and not self.log:
            raise ValueError("maxChanges needs a log")

    def _layout(self) -> dict:
        fs, inner = file_system(self.root)
        found = fs.get_file_info(pfs.FileSelector(f"{inner}/layout", allow_not_found=True))
        names = sorted(x.path for x in found if x.path.endswith(".json"))
        if not names:
            return {"seq": 0, "since": 0, "changes": [], "buckets": {}}
        with fs.open_input_stream(names[-1]) as f:
            return json.loads(f.read())

    def initialOffset(self) -> dict:
        return {"seq": 0}

    def _ended(self) -> int:
        fs, inner = file_system(self.log)
        if fs.get_file_info(inner).type != pfs.FileType.File:
            return 0
        with fs.open_input_stream(inner) as f:
            return json.loads(f.read())

    def latestOffset(self) -> dict:
        lay = self._layout()
        if not self.most:
            return {"seq": lay["seq"]}
        at = self._ended()
        new = [c["seq"] for c in lay["changes"] if c["seq"] > at]
        end = lay["seq"] if len(new) <= self.most else new[self.most - 1]
        if end != at:
            fs, inner = file_system(self.log)
            fs.create_dir(inner.rpartition("/")[0], recursive=True)
            with fs.open_output_stream(f"{inner}-aside") as f:
                f.write(json.dumps(end).encode())
            fs.move(f"{inner}-aside", inner)
        return {"seq": end}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        lay = self._layout()
        fs, inner = file_system(self.root)
        files = lambda folder: [x.path for x in fs.get_file_info(pfs.FileSelector(f"{inner}/{folder}")) if x.path.endswith(".parquet")]
        new = [c for c in lay["changes"] if start["seq"] < c["seq"] <= end["seq"]]
        out = []
        if start["seq"] < lay["since"] and start["seq"] < end["seq"] or any(c.get("whole") for c in new):
            new = [c for c in lay["changes"] if not c["merged"]]
            escaped = lambda i: re.sub(r"[\x00-\x1f\"#%'*/:=?\\\x7f{\[\]^]", lambda m: f"%{ord(m[0]):02X}", i)
            out = [File(p, 0) for i, own in lay["buckets"].items() for b, g in own.items() for p in files(f"docs/gen={g}/index={escaped(i)}/bucket={b}")]
        return out + [File(p, c["seq"]) for c in new if not c.get("whole") for p in files(f"changes/seq={c['seq']}")]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(self.root)
        folder = re.search(r"/index=([^/]*)/", partition.path)
        with fs.open_input_file(partition.path) as f:
            parquet = pq.ParquetFile(f)
            there = set(parquet.schema_arrow.names)
            for batch in parquet.iter_batches(ROWS, columns=[n for n in ARROW.names if n in there]):
                own = {"_seq": pa.array([partition.seq] * batch.num_rows, pa.int64())}
                if folder:
                    own["index"] = pa.array([unquote(folder[1])] * batch.num_rows, pa.string())
                yield pa.RecordBatch.from_arrays([own[x.name] if x.name in own else batch.column(x.name).cast(x.type) for x in ARROW], schema=ARROW)


class StoreFeed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "docpack_feed"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> FeedReader:
        return FeedReader(self.options)
