"""Raw payloads, reference files and the lake layers."""
