"""Writers: contract checks, quarantine, idempotent loads."""
