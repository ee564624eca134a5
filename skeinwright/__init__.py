"""Skeinwright: sensor-stream and corpus analytics as Spark DataFrame operators."""
