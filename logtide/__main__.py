"""Command line: ``python -m logtide <job> ...`` or through ``spark-submit``.

Jobs: batch, rules, runs, spikes, land, stream, generate, produce, consume.
"""

from __future__ import annotations

import argparse
import json

from . import fixed_values as fv
from .plans.batch import paced_batches, run_batch, run_job
from .session import build_session
from .settings import Settings
from .sinks.files import write_jsonl
from .sinks.kafka import publish, publish_stream
from .sources.files import stream_logs
from .sources.kafka import META, display_rows, read_first, stream_topic
from .sources.synthetic import generate_logs, stream_synthetic
from .streaming.compaction import WINDOW_KEYS, compacting_sink
from .streaming.fanout import fan_out, start_live, topics
from .streaming.live import start_console, writer


def read_settings(path: str | None) -> Settings:
    if path is None:
        return Settings()
    with open(path, encoding="utf-8") as text:
        return Settings.from_config(json.load(text))


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="logtide", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    batch = jobs.add_parser("batch", help="report on a log and export its service metrics")
    batch.add_argument("logs")
    batch.add_argument("output")
    batch.add_argument("--config")

    for job, text in (
        ("rules", "write the firings of the alert rules as JSON lines"),
        ("runs", "write the runs of consecutive errors as JSON lines"),
        ("spikes", "write the error spikes as JSON lines"),
        ("land", "write a log as Parquet by hour and service"),
    ):
        other = jobs.add_parser(job, help=text)
        other.add_argument("logs")
        other.add_argument("output")
        other.add_argument("--config")

    stream = jobs.add_parser("stream", help="live service metrics on the console")
    stream.add_argument("--source", choices=("file", "kafka"), default="file")
    stream.add_argument("--folder")
    stream.add_argument("--config")
    stream.add_argument("--mode", choices=("append", "update", "complete"), default="append")
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--sink", choices=("console", "parquet", "kafka"), default="console")
    stream.add_argument("--output", help="folder of the parquet sink")

    generate = jobs.add_parser("generate", help="write synthetic logs as JSON lines")
    generate.add_argument("output")
    generate.add_argument("--records", type=int, default=10000)
    generate.add_argument("--seed", type=int, default=42)
    generate.add_argument("--append", action="store_true")

    produce = jobs.add_parser("produce", help="publish synthetic logs to a topic")
    produce.add_argument("--servers", default="localhost:9092")
    produce.add_argument("--topic", default=fv.RAW_TOPIC)
    produce.add_argument("--records", type=int, help="number of records; endless unless given")
    produce.add_argument("--batch-size", type=int, default=100)
    produce.add_argument("--delay-ms", type=int, default=100)
    produce.add_argument("--seed", type=int, help="same records every time; fresh ones unless given")
    produce.add_argument("--checkpoint", help="needed for an endless stream")

    consume = jobs.add_parser("consume", help="show the first messages of a topic")
    consume.add_argument("--servers", default="localhost:9092")
    consume.add_argument("--topic", default=fv.RAW_TOPIC)
    consume.add_argument("--messages", type=int, help="number of messages; follow the topic unless given")
    consume.add_argument("--group", default="log-consumer-group")
    consume.add_argument("--checkpoint", help="needed to follow the topic")
    return parser


def main(argv: list[str] | None = None) -> None:
    options = arguments().parse_args(argv)
    spark = build_session(f"logtide-{options.job}")
    if options.job == "batch":
        run_batch(spark, options.logs, options.output, read_settings(options.config))
    elif options.job in ("rules", "runs", "spikes", "land"):
        run_job(spark, options.job, options.logs, options.output, read_settings(options.config))
    elif options.job == "stream":
        settings = read_settings(options.config)
        if options.source == "file":
            if not options.folder:
                raise SystemExit("--folder is needed for the file source")
            logs = stream_logs(spark, options.folder)
        else:
            logs = stream_topic(spark, settings.kafka_servers, settings.raw_topic)
        if options.sink == "console":
            running = start_console(logs, options.checkpoint, options.mode, settings)
        elif options.sink == "kafka":
            sink = topics(settings.kafka_servers)
            running = start_live(logs, sink, options.checkpoint, settings, options.mode, settings.trigger)
        else:
            if not options.output:
                raise SystemExit("--output is needed for the parquet sink")
            sink = fan_out(
                *(compacting_sink(f"{options.output}/{name}", WINDOW_KEYS, delay=settings.watermark) for name in ("metrics", "alerts"))
            )
            running = start_live(logs, sink, options.checkpoint, settings, options.mode, settings.trigger)
        running.awaitTermination()
    elif options.job == "generate":
        write_jsonl(generate_logs(spark, options.records, seed=options.seed), options.output, options.append)
    elif options.job == "produce":
        if options.records:
            for rows in paced_batches(spark, options.records, options.batch_size, options.delay_ms, options.seed):
                publish(rows, options.servers, options.topic)
        else:
            if not options.checkpoint:
                raise SystemExit("--checkpoint is needed for an endless stream")
            rows = stream_synthetic(spark, options.batch_size, options.delay_ms)
            publish_stream(rows, options.servers, options.topic, options.checkpoint).awaitTermination()
    elif options.messages:
        group = {"kafka.group.id": options.group}
        shown = display_rows(read_first(spark, options.servers, options.topic, options.messages, **group))
        shown.show(options.messages, truncate=False)
    else:
        if not options.checkpoint:
            raise SystemExit("--checkpoint is needed to follow a topic")
        group = {"kafka.group.id": options.group}
        logs = stream_topic(spark, options.servers, options.topic, "earliest", META, **group)
        writer(display_rows(logs), options.checkpoint).format("console").start().awaitTermination()


if __name__ == "__main__":
    main()
