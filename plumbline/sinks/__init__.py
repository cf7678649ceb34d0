"""Writers: batch folders with sidecars, keyed layouts, JDBC targets, versioned keyed tables."""
