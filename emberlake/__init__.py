"""Spark jobs and queries over an administrative-area lake of fire detections and weather readings."""
