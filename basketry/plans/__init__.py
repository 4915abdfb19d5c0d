"""Models by layer, the warehouse that wires them, and the ingest job."""
