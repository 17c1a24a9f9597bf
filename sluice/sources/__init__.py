"""Readers: permissive CSV, columnar JSON, ingestion prefixes, file manifests."""
