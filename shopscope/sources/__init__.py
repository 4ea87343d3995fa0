"""Raw table schemas, CSV loading, test-data adapters and the shared work folder."""
