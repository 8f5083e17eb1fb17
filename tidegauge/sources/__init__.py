from tidegauge.sources.employees import read_employees
from tidegauge.sources.lines import kafka_options, read_lines, stream_lines, widen
from tidegauge.sources.lines import message_text

__all__ = ["read_employees", "kafka_options", "read_lines", "stream_lines", "message_text",
           "widen"]
