"""A4: one named file a run, through the Python Data Source API.

``df.write.format("run_files").option("pattern", "{run_id}.json").mode("append").save(folder)`` writes the column ``document`` of each
row to the file that the pattern names.  Tasks write below ``_temporary`` in the folder; the commit of the job moves the
files of the tasks that it took, so a failed or repeated task leaves nothing and readers never see half a
file.  Two rows with one name are an error of the job.  Folders are local paths or any URI that ``pyarrow.fs`` opens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

FORMAT = "run_files"
PATTERN = "{run_id}.json"


def _source() -> type[DataSource]:
    """The data source class, made here so that it reaches the workers by value."""

    class Written(WriterCommitMessage):
        def __init__(self, files):
            self.files = files                                # (temporary path, final path)

    class RunFilesWriter(DataSourceWriter):
        def __init__(self, schema, options):
            self.columns = [f.name for f in schema.fields]
            self.path, self.pattern = options["path"], options.get("pattern", "{run_id}.json")

        def folder(self):
            import pyarrow.fs
            return pyarrow.fs.FileSystem.from_uri(self.path)

        def write(self, iterator):
            import uuid
            fs, base = self.folder()
            files = []
            for row in iterator:
                name = self.pattern.format(**{c: row[c] for c in self.columns if c != "document"})
                if not name or "/" in name or name.startswith((".", "_")):
                    raise ValueError(f"not a file name: {name!r}")
                temporary = f"{base}/_temporary/{uuid.uuid4().hex}"
                fs.create_dir(f"{base}/_temporary", recursive=True)
                with fs.open_output_stream(temporary) as f:
                    f.write((row["document"] or "").encode("utf-8"))
                files.append((temporary, f"{base}/{name}"))
            return Written(files)

        def commit(self, messages):
            fs, base = self.folder()
            files = [f for m in messages if m is not None for f in m.files]
            names = [final for _, final in files]
            twice = sorted({n for n in names if names.count(n) > 1}) if len(set(names)) < len(names) else []
            if twice:
                self.abort(messages)
                raise ValueError(f"several documents for one file: {twice[:5]}")
            fs.create_dir(base, recursive=True)
            for temporary, final in files:
                fs.move(temporary, final)

        def abort(self, messages):
            fs, _ = self.folder()
            for m in messages:
                for temporary, _ in m.files if m is not None else ():
                    fs.delete_file(temporary)

    class RunFiles(DataSource):
        @classmethod
        def name(cls):
            return "run_files"

        def writer(self, schema, overwrite):
            return RunFilesWriter(schema, dict(self.options))

    return RunFiles


def register_run_files(spark: SparkSession) -> None:
    spark.dataSource.register(_source())


def write_run_files(docs: DataFrame, path: str, pattern: str = PATTERN) -> None:
    """Each document of ``docs`` (document, and the columns that ``pattern`` names) as a file of its own below ``path``."""
    register_run_files(docs.sparkSession)
    docs.write.format(FORMAT).option("pattern", pattern).mode("append").save(path)
