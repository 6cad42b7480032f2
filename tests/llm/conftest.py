import pyarrow as pa
import pyarrow.parquet as pq
import pytest

DOCS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])


@pytest.fixture
def tables(tmp_path):
    """Writes tables to a folder and returns it: documents from texts, or (id, text) or (id, text, lang)."""

    def write(documents=(), benchmark=(), pages=(), **more):
        rows = []
        for i, x in enumerate(documents):
            x = x if isinstance(x, tuple) else (i, x)
            rows.append((x[0], x[1], x[2] if len(x) > 2 else "en", "src0", len(x[1]) if x[1] is not None else None))
        columns = [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(DOCS)]
        extra = {k: pa.array(v) for k, v in more.items()}
        pq.write_table(pa.table(dict(zip(DOCS.names, columns, strict=True)) | extra), tmp_path / "documents.parquet")
        ids, texts = zip(*benchmark, strict=True) if benchmark else ((), ())
        pq.write_table(pa.table({"item_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string())}), tmp_path / "benchmark.parquet")
        keys, urls = zip(*pages, strict=True) if pages else ((), ())
        pq.write_table(pa.table({"page_id": pa.array(keys, pa.int64()), "url": pa.array(urls, pa.string()), "html": pa.nulls(len(keys), pa.string())}), tmp_path / "pages.parquet")
        return str(tmp_path)

    return write
