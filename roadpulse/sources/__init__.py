"""Tables, documents, dimensions, streams and model artefacts."""
