"""Where rows come from: federated databases, managed tables, and what the catalog says of both."""
