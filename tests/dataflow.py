"""Runs definitions of declarative pipelines where Spark's own runner can't be started: it needs Spark Connect, which needs grpc.

A flow that reads what isn't there yet is tried again after the others; that is all the order there is.
"""

import shutil
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.pipelines.graph_element_registry import GraphElementRegistry, graph_element_registration_context
from pyspark.pipelines.output import StreamingTable, TemporaryView


class Definitions(GraphElementRegistry):
    def __init__(self, define):
        self.outputs, self.flows = {}, []
        with graph_element_registration_context(self):
            define()

    def register_output(self, output):
        assert output.name not in self.outputs
        self.outputs[output.name] = output

    def register_flow(self, flow):
        self.flows.append(flow)

    def register_sql(self, sql_text, file_path):
        raise NotImplementedError

    def tables(self):
        return [n for n, o in self.outputs.items() if not isinstance(o, TemporaryView)]


class Runner:
    def __init__(self, spark, definitions, database, root):
        self.spark, self.found, self.database, self.root = spark, definitions, database, Path(root)
        spark.sql(f"CREATE DATABASE {database}")

    def read(self, name):
        return self.spark.read.table(f"{self.database}.{name}")

    def _write(self, flow):
        rows = flow.func()
        output = self.found.outputs[flow.target]
        if isinstance(output, TemporaryView):
            assert not rows.isStreaming
            rows.createOrReplaceTempView(flow.target)
        elif isinstance(output, StreamingTable):
            assert rows.isStreaming
            rows.writeStream.option("checkpointLocation", f"{self.root}/{flow.name}").trigger(availableNow=True).toTable(f"{self.database}.{flow.target}").awaitTermination()
        else:
            assert not rows.isStreaming
            rows.write.mode("overwrite").saveAsTable(f"{self.database}.{flow.target}")

    def update(self, full_refresh=False):
        self.spark.sql(f"USE {self.database}")
        try:
            for name, output in self.found.outputs.items():
                if isinstance(output, TemporaryView):
                    self.spark.catalog.dropTempView(name)
                elif full_refresh or not isinstance(output, StreamingTable):
                    self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            if full_refresh:
                shutil.rmtree(self.root, ignore_errors=True)
            waiting, done = list(self.found.flows), set()
            while waiting:
                left = []
                for flow in waiting:
                    # Streaming tables are kept from update to update, so what feeds them goes first.
                    try:
                        self._write(flow)
                        done.add(flow.name)
                    except AnalysisException as e:
                        if e.getCondition() != "TABLE_OR_VIEW_NOT_FOUND":
                            raise
                        left.append(flow)
                assert len(left) < len(waiting), [f.name for f in left]
                waiting = left
        finally:
            for name, output in self.found.outputs.items():
                if isinstance(output, TemporaryView):
                    self.spark.catalog.dropTempView(name)
            self.spark.sql("USE default")
