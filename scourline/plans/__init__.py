"""Preset chains of operators."""

from .pipelines import PRESETS, export_pipeline, pipeline

__all__ = ["PRESETS", "export_pipeline", "pipeline"]
