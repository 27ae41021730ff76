"""DataFrame operators over units, sensor series and panels."""
