"""Column roles of the table being prepared, and the names derived from them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class SchemaSpec:
    target: str
    one_hot: tuple[str, ...]
    text: str
    date_start: str
    date_end: str
    day_difference: str
    key: str
    carried: tuple[str, ...] = ()
    unwanted: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()

    @property
    def numeric(self) -> tuple[str, ...]:
        return (self.day_difference,)

    @property
    def imputed_numeric(self) -> tuple[str, ...]:
        return tuple(f"im_{c}" for c in self.numeric)

    @property
    def imputed_one_hot(self) -> tuple[str, ...]:
        return tuple(f"im_{c}" for c in self.one_hot)

    @property
    def indexed_one_hot(self) -> tuple[str, ...]:
        return tuple(f"si_{c}" for c in self.one_hot)

    @property
    def encoded_one_hot(self) -> tuple[str, ...]:
        return tuple(f"tf_{c}" for c in self.one_hot)

    @property
    def encoded_text(self) -> str:
        return f"tf_{self.text}"

    @property
    def assembled_inputs(self) -> tuple[str, ...]:
        return (*self.encoded_one_hot, *self.imputed_numeric, self.encoded_text)

    @property
    def assembled(self) -> str:
        return "va_input_features"

    @property
    def scaled(self) -> str:
        return "scaled_input_features"

    @property
    def required_for_prediction(self) -> tuple[str, ...]:
        return (*self.one_hot, self.text, self.date_start, self.date_end)

    @property
    def required(self) -> tuple[str, ...]:
        return (self.target, *self.required_for_prediction)

    @property
    def declared(self) -> T.StructType:
        """Types of the modelled columns, as the feature store keeps them."""
        dates = (self.date_start, self.date_end)
        strings = (*self.one_hot, *self.carried, self.text, self.target)
        fields = [T.StructField(c, T.StringType()) for c in strings]
        fields += [T.StructField(c, T.TimestampType()) for c in dates]
        return T.StructType(fields)

    @property
    def landing(self) -> T.StructType:
        """Types of a landed record: the declared columns plus key and free columns, all nullable.

        Dates land as text and are cast later, so that one malformed date does not spoil a record.
        """
        names = dict.fromkeys(
            (self.key, *(f.name for f in self.declared), *self.unwanted, *self.optional)
        )
        return T.StructType([T.StructField(c, T.StringType()) for c in names])

    @property
    def stored(self) -> T.StructType:
        """Types of a record in the feature store: as landed, with the dates cast."""
        dates = {self.date_start, self.date_end}
        return T.StructType(
            [
                T.StructField(f.name, T.TimestampType() if f.name in dates else f.dataType)
                for f in self.landing
            ]
        )


COMPLAINTS = SchemaSpec(
    target="consumer_disputed",
    one_hot=("company_response", "consumer_consent_provided", "submitted_via"),
    text="issue",
    date_start="date_sent_to_company",
    date_end="date_received",
    day_difference="diff_in_days",
    key="complaint_id",
    carried=("timely", "company", "product", "state", "zip_code"),
    unwanted=("complaint_id", "sub_product", "complaint_what_happened"),
    optional=("company_public_response",),
)
