"""Stages over tables that grow: file sources, watermarks, stored state."""
