"""Writers: keyed tables and report sections."""
