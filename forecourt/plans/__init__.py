"""Pipelines that join operators together and stage shared intermediates."""
